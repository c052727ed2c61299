import random
import re

import numpy as np
import xxhash

from tripgrain.llm.queries import op3_simhash
from tripgrain.llm.simhash import (
    fingerprint,
    fuzzy_keys,
    keep_one_of_each,
    near_codewords,
    near_duplicates,
    spanning_links,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {upper: upper + 32 for upper in range(65, 91)}


def plain_fingerprint(text):
    found = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    ids = sorted(prints)
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def test_fingerprints():
    for text in ("", "  ", "One", "One two", "A\x0bb\x1cc d É e", "x y " * 70_000, "the Cat sat on the mat " * 9):
        assert fingerprint(text) == plain_fingerprint(text)


def test_golay_keys_reach_all_linked_pairs():
    chance = random.Random(3)
    values, pairs = [], []
    for _ in range(400):
        value = chance.getrandbits(64)
        other = value
        for bit in chance.sample(range(64), chance.randrange(3)):
            other ^= 1 << bit
        pairs.append((len(values), len(values) + 1))
        values += [value, other]
    position, keys = fuzzy_keys(np.array(values, np.uint64))
    by = {}
    for at, key in zip(position.tolist(), keys.tolist()):
        by.setdefault(at, set()).add(key)
    assert all(by[a] & by[b] for a, b in pairs)
    # Perfect code: the codewords within three bits of a word are exactly one.
    words = np.array([chance.getrandbits(23) for _ in range(50)], np.int64)
    assert set(near_codewords(words)[0].tolist()) == set(range(50))


def test_spanning_links_of_small_and_large_sets():
    chance = random.Random(4)
    base = chance.getrandbits(64)
    for size in (60, 2500):
        values = {base ^ sum(1 << b for b in chance.sample(range(20), chance.randrange(6))) for _ in range(size)}
        values |= {chance.getrandbits(64) for _ in range(size)}
        values = np.array(sorted(values), np.uint64)
        links = spanning_links(values)
        assert all((int(values[a]) ^ int(values[b])).bit_count() <= 2 for a, b in links)
        parent = {i: i for i in range(len(values))}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in links:
            assert root(a) != root(b)
            parent[root(a)] = root(b)
        for i in chance.sample(range(len(values)), 60):
            for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2).tolist():
                assert root(i) == root(j)


def texts():
    chance = random.Random(5)
    base = [" ".join(f"w{chance.randrange(500)}" for _ in range(80)) for _ in range(12)]
    rows = [None, "", " ", "one", "ONE"]
    for text in base:
        rows += [text, text, text.upper()]
        for _ in range(6):
            parts = text.split()
            parts[chance.randrange(80)] = "new"
            rows.append(" ".join(parts))
    return rows


def test_classes_against_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("text", "text")
    found = {r["doc_id"]: r for r in near_duplicates(df.withColumn("component_id", df["text"])).collect()}
    prints = {i: plain_fingerprint(text) for i, text in rows}
    best = plain_components(prints)
    assert {i: r["component_id"] for i, r in found.items()} == best
    assert {i: r["fingerprint"] % (1 << 64) for i, r in found.items()} == prints


def test_one_of_each_class_stays(spark):
    rows = [*enumerate(texts()), (3, "one"), (None, "alone with no id"), (None, "another of its own kind"),
            (None, "alone with no id"), (3, "the same id but quite another text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in keep_one_of_each(df).collect())
    best = plain_components({i: plain_fingerprint(text) for i, text in enumerate(texts())})
    expected = [*((False, i) for i in set(best.values())), (False, 3), (True, 0), (True, 0)]
    assert kept == sorted(expected)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(df).collect() == [] and keep_one_of_each(df).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    found = {r["doc_id"]: r for r in op3_simhash(spark, sf_dir).collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in found.items()} == prints
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(prints)
