import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tripgrain.llm.fingerprints import edited_neighbours, fingerprint_documents, likeness
from tripgrain.llm.queries import op8_fingerprints


def shingles(text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(one, other):
    a, b = shingles(one), shingles(other)
    return 1.0 if a == b else len(a & b) / len(a | b)


def test_estimates_follow_the_true_likeness(spark):
    base = [f"w{i}" for i in range(600)]
    rows = [(n, " ".join(base[n : n + 400])) for n in (0, 20, 60, 120, 200, 300)]
    df = fingerprint_documents(spark.createDataFrame(rows, "n int, text string"))
    found = {r["n"]: r["fingerprint"] for r in df.collect()}
    frame = spark.createDataFrame(
        [(i, j, found[i], found[j]) for i in found for j in found],
        "i int, j int, a array<bigint>, b array<bigint>",
    )
    texts = dict(rows)
    for r in frame.select("i", "j", likeness(frame["a"], frame["b"]).alias("near")).collect():
        assert abs(r["near"] - jaccard(texts[r["i"]], texts[r["j"]])) < 0.13


def test_short_and_empty_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c d e"), (7, "x " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as FINGERPRINT")
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprint_documents(df).collect()}
    assert found[1] == found[2] == found[3] == [] and found[4] == found[5] != found[6]
    assert all(len(found[i]) == 32 for i in (4, 5, 6, 7))


def neighbours(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, TIE int, packed int")
    near = likeness(F.col("packed"), F.col("packed_next")).alias("near")
    return edited_neighbours(df).select("id", "text", "n_chars", "edited", near).collect()


def test_order_nulls_and_repeated_rows(spark):
    rows = [(3, "abcdef"), (1, "12"), (2, "uvwxyz12"), (None, None), (2, "uvwxyz12")]
    found = sorted(((r["id"] or 0, r["edited"], r["n_chars"]) for r in neighbours(spark, [(*r, 1, 2) for r in rows])))
    assert found == [(0, "", 0), (1, "1", 2), (2, "uvwx12", 8), (2, "uvwx12", 8), (3, "abcuvw", 6)]
    assert [(r["edited"], r["near"]) for r in neighbours(spark, [(1, "abcd", 1, 2)])] == [("abab", 1.0)]
    assert neighbours(spark, []) == []


def test_query_against_brute_force(spark, sf_dir):
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    found = {r["doc_id"]: r for r in op8_fingerprints(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    errors, of_text = [], {}
    for at, (doc_id, text) in enumerate(docs):
        following, half, row = docs[(at + 1) % len(docs)][1], len(text) // 2, found[doc_id]
        edited = text[: len(text) - half] + following[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [row["near_edited"] - jaccard(text, edited), row["near_next"] - jaccard(text, following)]
        assert of_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04
