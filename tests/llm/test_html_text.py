import html
import re

from tripgrain.llm.html_text import ARTICLE, OPEN, blocks_of, extract_text
from tripgrain.llm.queries import op4_html_text


def test_blocks_by_markup():
    page = (
        "<!DOCTYPE html><head><title>no</title><style>p{}</style></head><body><header>H</header>"
        "<div class='main menu'>m <p>x</div><article><header><h1>T &amp; t</h1></header>a\n <b>b</b>"
        "<aside>no</aside>c<p title='a>b'>d <div id=comments>no<p>no</div> e<script>if(a<b)</script>"
        "<ul><li>1<li>2</ul><span hidden>no</span></article><form>q</form>tail<!-- <p>no -->"
    )
    texts = [text for standing, text in blocks_of(page) if standing == ARTICLE]
    assert texts == ["T & t", "a b", "c", "d", "e", "1", "2"]
    assert [text for standing, text in blocks_of(page) if standing == OPEN] == ["tail"]


def test_broken_markup():
    assert blocks_of("") == [] and blocks_of("<script>never closed") == []
    assert blocks_of("a &lt;b&gt <p>c <!-- open") == [(OPEN, "a <b>"), (OPEN, "c")]
    assert blocks_of("<article>x</div></nav>y") == [(ARTICLE, "x"), (ARTICLE, "y")]
    assert blocks_of("a < b <3") == [(OPEN, "a < b <3")]


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, TEXT int, host_ int")
    return df, {r["page_id"]: r["text"] for r in extract_text(df, run_words=4).collect()}


def plain(rows, run_words=4):
    """All pages of a host against each other."""
    def host(url):
        found = re.match(r"[a-z]+://([^/?#:]*)", url or "")
        return found.group(1) if found else ""

    streams = {}
    for _, url, page, *_ in rows:
        blocks = [t for s, t in blocks_of(page or "") if s == OPEN]
        if not any(s == ARTICLE for s, _ in blocks_of(page or "")):
            streams.setdefault(host(url), {})[page or ""] = blocks
    result = {}
    for page_id, url, page, *_ in rows:
        article = [t for s, t in blocks_of(page or "") if s == ARTICLE]
        if article:
            result[page_id] = "\n".join(article)
            continue
        mine = streams[host(url)][page or ""]
        words = " ".join(mine).split()
        others = set()
        for other, blocks in streams[host(url)].items():
            if other != (page or ""):
                w = " ".join(blocks).split()
                others |= {tuple(w[i : i + run_words]) for i in range(len(w) - run_words + 1)}
        hidden = set()
        for i in range(len(words) - run_words + 1):
            if tuple(words[i : i + run_words]) in others:
                hidden.update(range(i, i + run_words))
        kept, at = [], 0
        for block in mine:
            left = [w for i, w in enumerate(block.split(), at) if i not in hidden]
            at += len(block.split())
            kept += [" ".join(left)] if left else []
        result[page_id] = "\n".join(kept)
    return result


def test_repeated_runs_of_a_host_go(spark):
    top, end = "<div>home news about contact us</div>", "<div>all rights are held by us</div>"
    rows = [(i, f"https://a.example/{i}", f"{top}<p>{i} story tells {i}</p>{end}", 1, 1) for i in range(4)]
    rows += [
        (10, "https://b.example/", f"{top}<p>only page of its host</p>{end}", 1, 1),
        (11, "https://a.example/0", rows[0][2], 1, 1),
        (12, "https://a.example/x", f"<article>{top}</article>{end}", 1, 1),
        (13, None, f"{top}one", 1, 1), (14, "junk", f"{top}two", 1, 1),
        (15, None, None, 1, 1), (16, "https://a.example/y", "", 1, 1),
        (17, "https://c.example/", "<p>" + "many words " * 50_000, 1, 1),
    ]
    df, found = run(spark, rows)
    assert found == plain(rows)
    assert found[0] == "0 story tells 0" and found[13] == "one"
    assert found[12] == "home news about contact us"


def test_open_text_beside_an_article_is_judged(spark):
    """A story in `main` beside a teaser card, and what all pages of a host show beside their articles."""
    top, end = "<div>home news about contact us</div>", "<div>all rights are held by us</div>"
    rows = [
        (1, "https://a.example/1", f"{top}<main><p>the long story is told here</p><article>a card</article>"
            f"<p>and it ends there</p></main>{end}", 1, 1),
        (2, "https://a.example/2", f"{top}<article><p>two</p><p>all rights are held by us</p></article>{end}", 1, 1),
        (3, "https://a.example/3", f"{top}no article", 1, 1),
        (4, "https://b.example/4", "<div>go home</div><article>four</article>", 1, 1),
        (5, "https://b.example/5", "<div>go home</div><article>five</article>", 1, 1),
        (6, "https://b.example/6", "<div>go away</div><article>six</article>", 1, 1),
        (7, "https://c.example/7", "<div>go home</div>", 1, 1),
        (8, "https://c.example/8", "<div>go home</div>!", 1, 1),
        (9, "https://d.example/9", "<article>same text on two pages</article><p>nine</p>", 1, 1),
        (10, "https://d.example/10", "<article>same text on two pages</article><p>ten</p>", 1, 1),
        (11, "https://d.example/11", "<p>same text on two pages</p>", 1, 1),
    ]
    found = run(spark, rows)[1]
    assert found[1] == "the long story is told here\na card\nand it ends there"
    assert found[2] == "two\nall rights are held by us"
    assert found[3] == "no article"
    assert [found[i] for i in (4, 5, 6)] == ["four", "five", "go away\nsix"]
    assert [found[i] for i in (7, 8)] == ["go home", "go home\n!"]
    assert [found[i] for i in (9, 10)] == ["same text on two pages\n" + last for last in ("nine", "ten")]
    assert found[11] == "same text on two pages"


def test_empty_table(spark):
    assert run(spark, [])[1] == {}


def test_query_keeps_articles_whole(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r["page_id"]: r for r in op4_html_text(spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page["html"], re.DOTALL).group(1)
        blocks = [re.sub(r"<[^>]*>", "", part) for part in re.split(r"</?(?:p|h1)>", article)]
        expected = "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert found[page["page_id"]]["text"] == expected
        assert found[page["page_id"]]["n_chars"] == len(expected)
