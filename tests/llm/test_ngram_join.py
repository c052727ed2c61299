import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tripgrain.llm import ngram_join as g

KIND = "doc_id bigint, text string, node string, key int"


def plain_set(text, words=5):
    found = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    found = [w for part in [" ".join(found)] for w in part.split(" ") if w]
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def plain_classes(rows, percent=80, words=5):
    sets = [plain_set(text, words) for _, text, *_ in rows]
    parent = list(range(len(rows)))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        known = [x for x in (doc_id, least.get(root(i))) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((r[0], len(sets[i]), least[root(i)]) for i, r in enumerate(rows)), key=repr)


def classes(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], KIND).repartition(6)
    found = g.jaccard_classes(frame, **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, found.collect()), key=repr)


def near_copies(seed, groups=14, copies=8, longest=400):
    """Texts around the threshold: copies with words changed, put in and cut off, and chains of them."""
    pick, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{pick.randint(0, 5000)}" for _ in range(pick.choice([1, 3, 5, 6, 9, 14, 30, 63, 64, 65, 130, longest]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(pick.randint(0, max(1, len(words) // 18))):
                at = pick.randrange(len(words))
                words[at : at + pick.choice([0, 1, 1, 2])] = [f"v{pick.randint(0, 9)}"] * pick.choice([0, 1, 1, 2])
                words = words or ["x"]
            rows.append((len(rows), " ".join(words)))
            if pick.random() < 0.4:
                base = words
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = near_copies(seed)
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, rows[3][1]), (1003, rows[3][1].upper()), (1003, rows[3][1])]
    assert classes(spark, rows) == plain_classes(rows)


@pytest.mark.parametrize("percent", [40])
def test_sets_with_too_few_tokens_are_dealt_out_again(spark, percent):
    rows = near_copies(7, groups=8, copies=6, longest=90)
    ways = {g.tries_of(g.shingle_hashes(text), percent) for _, text in rows}
    assert g.MAX_TRIES in ways
    assert classes(spark, rows, min_percent=percent) == plain_classes(rows, percent)


def test_hot_tiles(spark, monkeypatch):
    """A passage in hundreds of short texts, and one large group of near copies, in many cells."""
    monkeypatch.setattr(g, "CELL_BYTES", 2048)
    monkeypatch.setattr(g, "FIRST_PAIRS", 1)
    pick = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"{passage} a{pick.randint(0, 30)} b{pick.randint(0, 3)}") for i in range(90)]
    base = [f"q{i}" for i in range(60)]
    for i in range(90, 200):
        words = list(base)
        for _ in range(pick.randint(0, 2)):
            words[pick.randrange(60)] = f"z{pick.randint(0, 3000)}"
        rows.append((i, " ".join(words)))
    rows += [(i, passage) for i in range(500, 560)]
    assert classes(spark, rows) == plain_classes(rows)


def test_odd_tables(spark):
    assert classes(spark, []) == []
    assert classes(spark, [(None, None), (None, "")]) == [(None, 0, None), (None, 0, None)]
    long = " ".join(f"w{i % 7919}x{i % 13}" for i in range(150_000))
    rows = [(1, long), (2, long + " more"), (3, "other"), (4, "x" * 1_000_000)]
    found = classes(spark, rows)
    assert [(r[0], r[2]) for r in found] == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_bitmaps_bound_from_above():
    pick = np.random.default_rng(3)
    for size in (1, 5, 63, 64, 200, 3000):
        a = np.unique(pick.integers(0, 1 << 63, size, dtype=np.uint64))
        for kept in (0, size // 2, size):
            fresh = pick.integers(0, 1 << 63, size // 3 + 1, dtype=np.uint64)
            b = np.unique(np.concatenate((a[:kept], fresh)))
            bound = g.overlap_bound(len(a), g.bitmap(a), len(b), g.bitmap(b))
            assert bound >= g.overlap(a, b) == len(np.intersect1d(a, b))


def test_rough_bitmaps_bound_from_above():
    pick = np.random.default_rng(4)
    for size in (1, 40, 64, 200, 3000):
        a = np.unique(pick.integers(0, 1 << 63, size, dtype=np.uint64))
        for kept in (0, size // 2, size):
            fresh = pick.integers(0, 1 << 63, size // 3 + 1, dtype=np.uint64)
            b = np.unique(np.concatenate((a[:kept], fresh)))
            bits_a, bits_b = (g.rough(g.bitmap(x)) for x in (a, b))
            whole = len(g.bitmap(a))
            assert len(bits_a) == min(whole, max(8 * g.ROUGH_WORDS, whole // g.ROUGH))
            assert g.overlap_bound(len(a), bits_a, len(b), bits_b) >= g.overlap(a, b)


def test_bitmaps_are_moved_once_for_each_tile(spark, capsys):
    """Of the shuffles that deal tiles into cells only the one by cells has bitmaps in its rows."""
    tiles = spark.createDataFrame([(1, 5, 5), (1, 6, 6), (2, 5, 5)], "key bigint, node bigint, root bigint")
    facts = spark.createDataFrame([(5, 9, b"x" * 64), (6, 9, b"y" * 64)], "node bigint, size bigint, bits binary")
    cells = g._cells(tiles, facts)
    cells.explain("formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert sum("key" in columns and "bits" in columns for columns in moved) == 1
    assert sorted((r["key"], r["i"], r["j"], r["node"], bytes(r["bits"])[:1]) for r in cells.collect()) == [
        (1, 0, 0, 5, b"x"), (1, 0, 0, 6, b"y")
    ]


def test_shared_tokens_are_among_the_first():
    """For every way of dealing out, similar sets have a tile in common."""
    pick = np.random.default_rng(9)
    for size in (5, 7, 20, 64, 100, 127, 128, 300, 1000):
        for _ in range(20):
            a = np.unique(pick.integers(0, 1 << 63, size, dtype=np.uint64))
            gone = int(pick.integers(0, size // 9 + 1))
            b = np.unique(np.concatenate((a[gone:], pick.integers(0, 1 << 63, gone, dtype=np.uint64))))
            common = len(np.intersect1d(a, b))
            if not g.enough(common, len(a), len(b), 80):
                continue
            for tries in range(g.MAX_TRIES + 1):
                larger = max(len(a), len(b))
                if max(len(g.tokens(x, g.band_of(larger), tries)) for x in (a, b)) > len(a) + len(b) - 2 * common:
                    assert np.isin(g.tile_keys(a, 80, tries), g.tile_keys(b, 80, tries)).any()


@pytest.mark.parametrize("width", [1, 2, 3, 50])
def test_runs_over_batches(width):
    pick = random.Random(width)
    rows = sorted((pick.randint(0, 9), pick.randint(0, 4)) for _ in range(60))
    columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
    batch = pa.RecordBatch.from_arrays(columns, ["key", "node"])
    batches = [batch.slice(at, width) for at in range(0, 60, width)]
    found = [tuple(row.values()) for out in g._shared_runs(batches) for row in out.to_pylist()]
    expected = []
    for key in {k for k, _ in rows}:
        nodes = sorted({n for k, n in rows if k == key})
        expected += [(key, node, nodes[0]) for node in nodes if len(nodes) > 1]
    assert sorted(found) == sorted(expected)
