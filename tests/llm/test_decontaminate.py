import hashlib
import random
import re

from tripgrain.llm import decontaminate
from tripgrain.llm.decontaminate import find_contamination, is_contaminated, remove_contamination
from tripgrain.llm.queries import op5_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {upper: upper + 32 for upper in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=13):
    doc = words(text)
    hit, found = set(), set()
    for item, content in items:
        seq = words(content)
        size = min(window, len(seq))
        grams = {tuple(seq[i : i + size]) for i in range(len(seq) - size + 1)} if seq else set()
        for i in range(len(doc) - size + 1) if seq else ():
            if tuple(doc[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(item)
    return len(doc), len(hit), sorted(x for x in found if x is not None)


def check(spark, docs, items):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    df = df.withColumn("HITS", df["doc_id"])
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = find_contamination(df, bench).collect()
    assert len(rows) == len(docs)
    for row in rows:
        n_words, n_hit, found = brute(row["text"], items)
        assert (row["n_words"], row["n_hit"], row["items"]) == (n_words, n_hit, found), row


def corpus(seed):
    chance = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdeé"
    item = lambda n: " ".join(chance.choice(letters) for _ in range(n))
    items = [(str(i), item(chance.choice([1, 3, 5, 12, 13, 14, 30, 40]))) for i in range(12)]
    docs = []
    for _ in range(40):
        parts = [item(chance.randrange(20))]
        for _ in range(chance.randrange(3)):
            seq = chance.choice(items)[1].split()
            start = chance.randrange(len(seq))
            parts += [" ".join(seq[start : start + chance.randrange(40)]).upper(), item(3)]
        docs.append("; ".join(parts))
    return docs, items


def test_against_brute_force(spark):
    for seed in range(4):
        check(spark, *corpus(seed))


def test_long_windows_only(spark):
    docs, items = corpus(3)
    check(spark, docs, [(i, t) for i, t in items if len(t.split()) >= 13])


def test_nulls_ties_and_empty_items(spark):
    long = " ".join(f"w{i}" for i in range(20))
    items = [(None, long), ("a", long), ("a", long), ("b", None), ("c", "..."), ("d", "Ünï")]
    check(spark, [None, "", "...", long, long, long.upper(), "ünï", "Ünï x", "x " * 200_000 + long], items)


def test_empty_tables(spark):
    check(spark, ["some words"], [])
    df = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([("a", "x")], "item_id string, text string")
    assert find_contamination(df, bench).collect() == []


def test_several_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 17)
    for seed in (4, 5):
        check(spark, *corpus(seed))


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(r["item_id"] if r["item_id"] is None else str(r["item_id"]), r["text"])
             for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r for r in op5_decontamination(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    assert any(r["contaminated"] for r in found.values())
    for doc in docs:
        row = found[doc["doc_id"]]
        n_words, n_hit, ids = brute(doc["text"], items)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n_words, n_hit, len(ids))
        assert row["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert row["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)


def brute_kept(text, items, max_span, max_share, window=13):
    """Words that stay, and how many go."""
    doc, hit = words(text), set()
    for _, content in items:
        seq = words(content)
        size = min(window, len(seq))
        grams = {tuple(seq[i : i + size]) for i in range(len(seq) - size + 1)} if seq else set()
        for i in range(len(doc) - size + 1) if seq else ():
            if tuple(doc[i : i + size]) in grams:
                # Passages that touch are one: mark what joins the words as well.
                hit.update(range(2 * i, 2 * (i + size) + 1))
    runs, run = [], []
    for at in range(2 * len(doc) + 2):
        if at in hit:
            run.append(at)
        elif run:
            runs.append({n // 2 for n in run[:-1]})
            run = []
    if sum(map(len, runs)) <= max_share * len(doc):
        runs = [found for found in runs if len(found) > max_span]
    gone = set().union(*runs)
    return [word for at, word in enumerate(doc) if at not in gone], len(gone)


def test_removal_against_brute_force(spark):
    for seed, max_span, max_share in ((0, 0, 0.0), (1, 14, 1.0), (2, 14, 0.5), (3, 1000, 0.3)):
        docs, items = corpus(seed)
        docs += ["", "...", " ".join(["x"] * 50_000) + " " + items[0][1]]
        df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
        df = df.selectExpr("doc_id", "text", "doc_id as HITS", "doc_id as row", "doc_id as found")
        bench = spark.createDataFrame(items, "item_id string, text string")
        left = remove_contamination(df, bench, max_span=max_span, max_share=max_share)
        rows = left.collect()
        assert sorted(row["doc_id"] for row in rows) == list(range(len(docs)))
        for row in rows:
            kept, gone = brute_kept(docs[row["doc_id"]], items, max_span, max_share)
            assert (words(row["text"]), row["n_removed"]) == (kept, gone)
            assert row["HITS"] == row["row"] == row["found"] == row["doc_id"]
            if not gone:
                assert row["text"] == docs[row["doc_id"]]


def test_removal_keeps_signs_nulls_and_empty_tables(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    bench = spark.createDataFrame([("a", passage)], "item_id string, text string")
    docs = [f"Été, before: {passage.upper()} -- after.", None, passage, f"one\n{passage}\ntwo"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    left = {row["doc_id"]: row["text"] for row in remove_contamination(df, bench).collect()}
    assert left == {0: "Été, before: -- after.", 1: None, 2: "", 3: "one\n\ntwo"}
    assert remove_contamination(df.limit(0), bench).collect() == []
    whole = remove_contamination(df, bench.limit(0)).collect()
    assert {row["doc_id"]: row["text"] for row in whole} == dict(enumerate(docs))
