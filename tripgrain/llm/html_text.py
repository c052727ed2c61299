"""Main text of web pages, with boilerplate found by repeated runs inside a host.

Markup decides what it can: text inside an article is main text, text in menus, headers, footers,
sidebars, forms, adverts, notices and reader comments is not. Text that markup leaves open is judged
by a suffix array of its host: the word streams of all pages of a host are put end to end, and a
word run of `RUN_WORDS` or more that occurs in distinct pages is boilerplate; the unique runs
between stay, on pages with an article as on those without one. Suffixes are brought together by host
and the hash of their first `RUN_WORDS` words: these are the intervals of the array whose longest common
prefixes reach that length, so neighbours with that much in common meet wherever they are.

Repeated runs alone would also take out articles that a host shows on two pages, which are main
text; this is why an article is left whole and takes no part in the search. Beside an article, open text
of fewer words than a run is one run: it goes if another page has the same and no more open text.

Defined results: NULL and empty pages have the empty text; a page without host is of the host "";
rows with the same page on the same host are one page; text nested in unclosed or wrongly nested
elements counts to the nearest open container; result columns replace input columns of the same
name. Pages are read whole.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.columns import fresh_name, prepare_workers, whole_text, with_results

RUN_WORDS = 8

# Element names of HTML and the words sites use in classes, ids and roles.
RAW = {"script", "style", "template", "noscript", "iframe", "object", "svg", "math", "title",
       "textarea", "select", "canvas", "audio", "video"}
DROPPED = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "fieldset"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
          "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
          "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
          "thead", "tr", "ul"}
SPACES = {"br", "td", "th", "wbr", "img"}
CONTAINERS = DROPPED | {"html", "body", "main", "article", "section", "div", "header", "table",
                        "ul", "ol", "dl", "figure", "details", "span", "p", "blockquote"}
CLOSES_PARAGRAPH = BLOCKS - {"body", "html", "head"}
WHOLE_PAGE = {"html", "body", "main", "article"}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|"
    r"pop-?up|modal|overlay|newsletter|subscri\w+|side-?bar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|masthead|topbar|comments?|disqus|respond|repl(?:y|ies)|related|"
    r"recommended|shar(?:e|ing)|social|widgets?|log-?in|sign-?up|paywall|skip-?link)(?:$|[\s_-])",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alert", "alertdialog", "menu", "menubar"}

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(\bhidden\b)")

ARTICLE, OPEN, DROP = 2, 1, 0


def _is_dropped(tag: str, attributes: str) -> bool:
    """True if an element's name or attributes say that it is not main text."""
    if tag in DROPPED:
        return True
    if tag in WHOLE_PAGE or not attributes.strip():
        return False
    for name, double, single, bare, hidden in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), references.unescape(double or single or bare)
        if hidden or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id") and HINT.search(value):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks_of(page: str) -> list[tuple[int, str]]:
    """The page's blocks in order, each with its standing: ARTICLE, OPEN or DROP."""
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", OPEN)]
    parts: list[str] = []
    at, end = 0, len(page)

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((stack[-1][1], text))
            parts.clear()

    while at < end:
        found = MARKUP.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and stack[-1][1]:
            parts.append(references.unescape(text))
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing and not attributes.rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE)
            ended = close.search(page, at)
            at = ended.end() if ended else end
            continue
        if tag in BLOCKS:
            close_block()
        elif tag in SPACES:
            parts.append(" ")
        if tag not in CONTAINERS:
            continue
        names = [name for name, _ in stack]
        if closing:
            if tag in names:
                if tag not in BLOCKS and stack[-1][1] != stack[names.index(tag) - 1][1]:
                    close_block()
                del stack[len(names) - 1 - names[::-1].index(tag) :]
            continue
        if tag in CLOSES_PARAGRAPH and "p" in names:
            # A paragraph ends where a block begins, unless a container opened inside of it.
            if names[-1] == "p":
                stack.pop()
        standing = stack[-1][1]
        if standing and (_is_dropped(tag, attributes) or tag == "header" and standing == OPEN):
            new = DROP
        else:
            new = ARTICLE if standing and tag == "article" else standing
        if new != standing:
            close_block()
        if not attributes.rstrip().endswith("/") or tag not in ("span", "div"):
            stack.append((tag, new))
    close_block()
    return [block for block in blocks if block[0]]


PARSED = "struct<blocks:array<string>,open:array<int>>"


def _parsed(page: Column) -> Column:
    """The blocks of a page that are not dropped, and the places of those that markup leaves open."""

    def parse_batch(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages:
            blocks = blocks_of(page.as_py())
            undecided = [at for at, (standing, _) in enumerate(blocks) if standing == OPEN]
            rows.append({"blocks": [text for _, text in blocks], "open": undecided})
        kinds = [("blocks", pa.list_(pa.string())), ("open", pa.list_(pa.int32()))]
        return pa.array(rows, type=pa.struct(kinds))

    return F.arrow_udf(parse_batch, PARSED)(page)


def repeated_runs(streams: DataFrame, run_words: int) -> DataFrame:
    """`host, page, starts`: where in a page runs begin that distinct pages of its host share.

    `streams` has `host`, `page`, the word stream `words`, and `whole`, which makes a stream of fewer
    words one run. Counting is combined before the shuffle, and a frequent run is one key of many, so a
    host of any size is spread out.
    """
    last = F.size("words") - run_words
    starts = (
        F.when(last >= 0, F.sequence(F.lit(0), last))
        .when(F.col("whole"), F.array(F.lit(0)))
        .otherwise(F.array().cast("array<int>"))
    )
    hashed = F.transform(
        starts,
        lambda at: F.struct(
            at.alias("at"), F.xxhash64(F.slice("words", at + 1, run_words)).alias("run")
        ),
    )
    suffixes = streams.select("host", "page", F.explode(hashed).alias("s")).select(
        "host", "page", "s.run", "s.at"
    )
    shared = (
        suffixes.groupBy("host", "run")
        .agg(F.min("page").alias("low"), F.max("page").alias("high"))
        .filter("low <> high")
        .select("host", "run")
    )
    return (
        suffixes.join(shared, ["host", "run"])
        .groupBy("host", "page")
        .agg(F.array_sort(F.collect_set("at")).alias("starts"))
    )


def _unique_runs(blocks: Column, undecided: Column, starts: Column, run_words: int) -> Column:
    """Blocks, those in `undecided` without the words that repeated runs cover."""

    def strip_batch(pages: pa.Array, places: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for page, judged, covered in zip(pages.to_pylist(), places.to_pylist(), found.to_pylist()):
            hidden = {start + i for start in covered or () for i in range(run_words)}
            judged = set(judged)
            kept, at = [], 0
            for place, block in enumerate(page):
                if place not in judged:
                    kept.append(block)
                    continue
                words = block.split(" ")
                left = [word for i, word in enumerate(words, at) if i not in hidden]
                at += len(words)
                if left:
                    kept.append(" ".join(left))
            rows.append(kept)
        return pa.array(rows, type=pa.list_(pa.string()))

    return F.arrow_udf(strip_batch, "array<string>")(blocks, undecided, starts)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def extract_text(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    text: str = "text",
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """Pages with a column of their main text, blocks joined by a line feed."""
    prepare_workers(pages.sparkSession)
    parsed, host, page = (fresh_name(pages, name) for name in ("parsed", "host_", "page_"))
    marked = pages.withColumn(parsed, _parsed(whole_text(html)))
    undecided = F.size(f"{parsed}.open") > 0
    open_pages = marked.filter(undecided).withColumns(
        {host: host_of(F.col(f"`{url}`")), page: F.xxhash64(whole_text(html))}
    )
    blocks, places = F.col(f"{parsed}.blocks"), F.col(f"{parsed}.open")
    words = F.split(F.array_join(F.transform(places, lambda at: blocks[at]), " "), " ")
    streams = open_pages.select(
        F.col(host).alias("host"),
        F.col(page).alias("page"),
        words.alias("words"),
        (F.size(blocks) > F.size(places)).alias("whole"),
    )
    covered = repeated_runs(streams, run_words).withColumnsRenamed({"host": host, "page": page})
    starts = fresh_name(pages, "starts_")
    joined = open_pages.join(covered.withColumnRenamed("starts", starts), [host, page], "left")
    unique = _unique_runs(blocks, places, F.col(starts), run_words)
    settled = marked.filter(~undecided)
    line_feed = "\n"
    done = settled.withColumn(parsed, F.array_join(blocks, line_feed)).select(
        *[f"`{name}`" for name in pages.columns], parsed
    )
    judged = joined.withColumn(parsed, F.array_join(unique, line_feed)).select(
        *[f"`{name}`" for name in pages.columns], parsed
    )
    return with_results(done.unionByName(judged), {text: F.col(parsed)}).drop(parsed)
