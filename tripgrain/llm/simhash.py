"""Near-duplicate classes by SimHash fingerprints, with fuzzy keys from the binary Golay code.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. Two fingerprints that differ
in at most two bits have a segment without difference, and of the other two segments one with at
most one. The Golay code of length 23 is perfect: each word lies within three bits of exactly one
codeword. Listing for a segment every codeword within four bits makes two words that differ in one
bit share one, so the pairs (segment that agrees, codeword near another segment) are keys of
which linked fingerprints have one in common. Candidates under a key are verified exactly.

Only distinct fingerprints are keyed, so a group of copies is one entry. Under one key a chain of
verified links stands for all of them, found by comparing, or from some size on by looking up
every fingerprint within two bits, so the work is linear in the entries of a key.

Defined results: NULL and empty texts have the fingerprint zero and are linked like any other;
rows with equal ids are separate entries; a NULL id never is a class id unless all ids of its
class are NULL; an empty table gives an empty result; texts are read whole; result columns replace
input columns of the same name.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.llm.columns import fresh_name, prepare_workers, whole_text
from tripgrain.llm.components import connected_components

SEED = 42
MAX_DISTANCE = 2
# Offset and width of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
CODE_LENGTH, CODE_BITS, NEAR = 23, 12, 4
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the Golay code.
GENERATOR = 0b110001110101

_MASK = (1 << 64) - 1
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included, as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    normal = b" ".join(words)
    count = max(1, len(words) - shingle_words + 1)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = (np.concatenate(([0], ends))[:count]).tolist()
    stops = (ends[len(words) - count :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, count, _HASHES_AT_ONCE):
        spans = zip(starts[low : low + _HASHES_AT_ONCE], stops[low : low + _HASHES_AT_ONCE])
        hashes = np.array([digest(normal[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > count, bitorder="little")
    return int(majority.view(np.uint64)[0])


def fingerprints(text: Column, shingle_words: int = 3) -> Column:
    """Fingerprints as signed longs."""

    def hash_batch(texts: pa.Array) -> pa.Array:
        values = [fingerprint(text, shingle_words) for text in texts.to_pylist()]
        return pa.array(np.array(values, np.uint64).view(np.int64), type=pa.int64())

    return F.arrow_udf(hash_batch, "bigint")(text)


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each word's low part, and per syndrome the error patterns up to `NEAR` bits.

    Returns the syndrome table for words split in two halves, and the padded error patterns.
    """
    checks = CODE_LENGTH - CODE_BITS

    def remainder(word: int) -> int:
        for bit in range(CODE_LENGTH - 1, checks - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - checks)
        return word

    of_bit = [remainder(1 << bit) for bit in range(CODE_LENGTH)]
    syndromes = np.zeros(1 << CODE_LENGTH, np.uint16)
    for bit, value in enumerate(of_bit):
        syndromes[1 << bit : 2 << bit] = syndromes[: 1 << bit] ^ value
    near: dict[int, list[int]] = {}
    for weight in range(NEAR + 1):
        for places in combinations(range(CODE_LENGTH), weight):
            pattern = sum(1 << place for place in places)
            near.setdefault(int(syndromes[pattern]), []).append(pattern)
    most = max(map(len, near.values()))
    patterns = np.zeros((1 << checks, most), np.int64)
    counts = np.zeros(1 << checks, np.int64)
    for syndrome, found in near.items():
        patterns[syndrome, : len(found)] = found
        counts[syndrome] = len(found)
    return syndromes, patterns, counts


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words all codewords within `NEAR` bits: positions in `words`, message indices."""
    syndromes, patterns, counts = _golay()
    found = syndromes[words].astype(np.int64)
    position = np.repeat(np.arange(len(words)), counts[found])
    first = np.cumsum(counts[found]) - counts[found]
    which = np.arange(len(position)) - first[position]
    codewords = words[position] ^ patterns[found[position], which]
    return position, codewords >> (CODE_LENGTH - CODE_BITS)


def _segment(values: np.ndarray, which: int) -> np.ndarray:
    offset, width = SEGMENTS[which]
    return (values >> np.uint64(offset) & np.uint64((1 << width) - 1)).astype(np.int64)


def fuzzy_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints: positions in `values`, and keys."""
    positions, keys = [], []
    segments = [_segment(values, which) for which in range(len(SEGMENTS))]
    for near in range(len(SEGMENTS)):
        position, index = near_codewords(segments[near])
        for same in range(len(SEGMENTS)):
            if same != near:
                pair = near * len(SEGMENTS) + same
                exact = segments[same][position]
                positions.append(position)
                keys.append((pair << CODE_BITS | index) << CODE_LENGTH | exact)
    return np.concatenate(positions), np.concatenate(keys)


@lru_cache(maxsize=1)
def _flips() -> np.ndarray:
    """All patterns of one to `MAX_DISTANCE` bits."""
    return np.array(
        [
            sum(1 << place for place in places)
            for weight in range(1, MAX_DISTANCE + 1)
            for places in combinations(range(64), weight)
        ],
        np.uint64,
    )


def spanning_links(values: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect just what all links within `MAX_DISTANCE` bits connect.

    `values` are distinct. Small sets are compared with each other; in larger ones each value
    looks up its possible neighbours.
    """
    parent = list(range(len(values)))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = node = parent[parent[node]]
        return node

    links, flips = [], _flips()
    place = {value: at for at, value in enumerate(values.tolist())}
    for at, value in enumerate(values):
        if len(values) <= len(flips):
            near = np.flatnonzero(np.bitwise_count(values[:at] ^ value) <= MAX_DISTANCE).tolist()
        else:
            near = [place[v] for v in (flips ^ value).tolist() if place.get(v, at) < at]
        for other in near:
            mine, theirs = root(at), root(other)
            if mine != theirs:
                parent[mine] = theirs
                links.append((at, other))
    return links


def _with_keys(batches):
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        position, keys = fuzzy_keys(values.view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(values[position])], names=["key", "value"]
        )


def _linked(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[int]]:
    """Links inside each run of equal keys."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    bounds = np.concatenate(([0], edges, [len(keys)]))
    sizes = np.diff(bounds)
    left, right = [], []
    # Runs of two, by far the most frequent beyond one, at once.
    twos = bounds[:-1][sizes == 2]
    pair = values[twos], values[twos + 1]
    close = np.bitwise_count(pair[0] ^ pair[1]) <= MAX_DISTANCE
    left += pair[0][close].view(np.int64).tolist()
    right += pair[1][close].view(np.int64).tolist()
    for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        run = values[start : start + size]
        signed = run.view(np.int64)
        for a, b in spanning_links(run):
            left.append(int(signed[a]))
            right.append(int(signed[b]))
    return left, right


def _link_runs(batches):
    """Links from rows sorted by key. The run of keys that a batch ends in is carried over."""
    rest_keys, rest_values = np.empty(0, np.int64), np.empty(0, np.int64)
    names, empty = ["a", "b"], pa.array([], type=pa.int64())

    def links(keys, values):
        left, right = _linked(keys, values.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names)

    for batch in batches:
        keys, values = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        keys, values = np.concatenate((rest_keys, keys)), np.concatenate((rest_values, values))
        if not len(keys):
            continue
        done = int(np.searchsorted(keys, keys[-1], side="left"))
        if done:
            yield links(keys[:done], values[:done])
        rest_keys, rest_values = keys[done:], values[done:]
    if len(rest_keys):
        yield links(rest_keys, rest_values)
    else:
        yield pa.RecordBatch.from_arrays([empty, empty], names)


def fingerprint_links(distinct: DataFrame, value: str) -> DataFrame:
    """Links `a, b` whose components are those of all pairs within `MAX_DISTANCE` bits."""
    keyed = distinct.select(F.col(value).cast("bigint")).mapInArrow(
        _with_keys, "key bigint, value bigint"
    )
    together = keyed.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(_link_runs, "a bigint, b bigint").distinct()


def _classes(
    documents: DataFrame, id_column: str, text: str, shingle_words: int
) -> tuple[DataFrame, DataFrame]:
    """`id, fingerprint` of each document, and `fingerprint, smallest, root` of each fingerprint.

    `smallest` is the smallest id with the fingerprint; those of a class have the same root. The
    fingerprints are computed once and stored.
    """
    prepare_workers(documents.sparkSession)
    hashed = cut_lineage(
        documents.select(
            F.col(f"`{id_column}`").alias("id"),
            fingerprints(whole_text(text), shingle_words).alias("fingerprint"),
        )
    )
    smallest = hashed.groupBy("fingerprint").agg(F.min("id").alias("smallest"))
    roots = connected_components(fingerprint_links(smallest, "fingerprint"))
    placed = smallest.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    return hashed, cut_lineage(placed)


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", shingle_words: int = 3
) -> DataFrame:
    """`id_column`, `fingerprint` (signed long) and `component_id`, the smallest id of the class.

    One row per document.
    """
    hashed, placed = _classes(documents, id_column, text, shingle_words)
    least = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = placed.select("fingerprint", "root").join(least, "root").drop("root")
    return hashed.join(classes, "fingerprint").select(
        F.col("id").alias(id_column), "fingerprint", "component_id"
    )


def keep_one_of_each(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", shingle_words: int = 3
) -> DataFrame:
    """The documents without near copies: of each class the one of the smallest id stays.

    Of rows equal in id and fingerprint one stays, whichever; a class without ids keeps one row.
    """
    _, placed = _classes(documents, id_column, text, shingle_words)
    first = F.min(F.struct(F.col("smallest").isNull(), "smallest", "fingerprint")).alias("first")
    row, mark = fresh_name(documents, "first_id"), fresh_name(documents, "fingerprint_of")
    chosen = placed.groupBy("root").agg(first).select(
        F.col("first.smallest").alias(row), F.col("first.fingerprint").alias(mark)
    )
    hashed = documents.withColumn(mark, fingerprints(whole_text(text), shingle_words))
    kept = hashed.join(
        chosen,
        hashed[f"`{id_column}`"].eqNullSafe(chosen[row]) & (hashed[mark] == chosen[mark]),
        "left_semi",
    )
    return kept.dropDuplicates([id_column, mark]).drop(mark)


def as_hex(value: Column) -> Column:
    """16 lower-case digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))

