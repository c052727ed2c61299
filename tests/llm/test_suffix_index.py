import hashlib
import random
from collections import Counter

import pytest

from tripgrain.llm import suffix_index
from tripgrain.llm.queries import op6_suffix_dedup
from tripgrain.llm.suffix_index import remove_repeats


def brute(texts, size):
    data = [(text or "").encode() for text in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    result = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return result


def corpus(seed):
    chance = random.Random(seed)
    word = lambda n: "".join(chance.choice("abcdefghié ") for _ in range(n))
    shared = [word(n) for n in (139, 140, 141, 300, 700)]
    texts = [None, "", "short", "ab" * 600, "abc" * 300 + word(50), word(3000)]
    for _ in range(30):
        parts = [word(chance.randrange(400))]
        for _ in range(chance.randrange(4)):
            source = chance.choice(shared)
            start = chance.randrange(60)
            parts += [source[start : start + chance.randrange(80, 700)], word(chance.randrange(120))]
        texts.append("".join(parts))
    base = word(2500)
    for _ in range(12):
        at = chance.randrange(2500)
        texts.append(base[:at] + word(3) + base[at + chance.randrange(4) :])
    return texts + texts[6:9]


def check(spark, texts, size):
    rows = [(i, text, "x") for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, K1 string")
    found = {r["doc_id"]: r for r in remove_repeats(df, min_bytes=size).collect()}
    assert len(found) == len(texts)
    for i, expected in enumerate(brute(texts, size)):
        row = found[i]
        removed = sum(s["end"] - s["start"] for s in row["spans"])
        assert (row["n_bytes"], removed, len(row["spans"]), bytes(row["kept"])) == expected, i
        assert row["K1"] == "x"


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, corpus(seed), 140)


def test_other_paths_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_index, "MAX_TOGETHER", 1)
    monkeypatch.setattr(suffix_index, "PIECE", 256)
    check(spark, corpus(3), 140)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert remove_repeats(df).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in op6_suffix_dedup(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    total = 0
    for doc, (n_bytes, removed, spans, kept) in zip(docs, brute([d["text"] for d in docs], 400)):
        row = found[doc["doc_id"]]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (n_bytes, removed, spans)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        total += removed
    assert total > 0
