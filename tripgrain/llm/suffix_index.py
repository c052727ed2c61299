"""Removal of long repeated strings with a logarithmic family of suffix arrays.

A string of `min_bytes` bytes that starts at two places has, at both, the same smallest hash among
its grams of `GRAM` bytes (the leftmost of equals). So only the suffixes that start at such grams
are indexed, about one in 170 positions. A suffix entry is the hash of its gram (`gram`), the hash of
all bytes of the strings whose smallest gram it is (`context`), and how often that was seen. Entries
sorted by both hashes are a sparse suffix array in which equal strings are neighbours.

Documents come in batches. A batch becomes an array of its own, is scanned side by side with every
array of the family for grams that both have, and is then merged with arrays of its size: arrays of
one batch merge to one of two, those to one of four, and so on. Any batch meets only a logarithmic
number of arrays, and an entry is rewritten a logarithmic number of times.

Entries with an equal context are repeated as a whole. Where contexts around a gram differ, one
representative of each is read from its text and the strings inside are compared by hash, so edges
of repeats are exact to the byte. Grams with very many contexts are compared by a shuffle instead
of side by side in a task; the result is the same.

Defined results: NULL and empty texts are empty and keep nothing; texts shorter than `min_bytes`
keep everything; equal rows are two occurrences of each of their strings; rows are told apart by
their text alone, so NULL or equal ids do not matter; an empty table gives an empty result; result
columns replace input columns of the same name. Strings are compared as UTF-8 bytes of whole texts
and judged on the input; hashes have 64 bits for the gram and 64 for the context around it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.durable import remove_path, scratch_path
from tripgrain.llm.columns import fresh_name, prepare_workers, whole_text, with_results

MIN_BYTES, GRAM = 400, 64
BATCHES = 4
# Strings that start in a piece of so many bytes are handled at once, whatever a text's length.
PIECE = 1 << 19
# Contexts of one gram that are compared side by side; more of them go through a shuffle.
MAX_TOGETHER = 20_000

_POSITION = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

KEY = ["k1", "k2"]
ENTRY = ["gram", "context"]


def text_key(text: Column) -> list[Column]:
    """128 bits by which texts are told apart."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and the powers of the base and of its inverse."""
    letters = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
    length = PIECE + (1 << 16)
    powers = np.full(length, _BASE, np.uint64)
    inverses = np.full(length, _INVERSE, np.uint64)
    powers[0] = inverses[0] = 1
    return letters, np.multiply.accumulate(powers), np.multiply.accumulate(inverses)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class RangeHashes:
    """Hashes of any ranges of a piece of text, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        letters, self.powers, inverses = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * inverses[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.powers[starts])

    def of_length(self, length: int) -> np.ndarray:
        """Of all ranges of a length, by start."""
        last = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:last]) * self.powers[:last])


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` values in a row: minima of blocks from both of their ends."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def suffix_entries(data: bytes, min_bytes: int) -> tuple[np.ndarray, ...]:
    """`gram, context, start, end, offset` of a text's entries.

    The strings of an entry start at `start` and later and together cover `start` to `end`; their
    common smallest gram lies `offset` behind `start`.
    """
    found = []
    width = min_bytes - GRAM + 1
    whole = np.frombuffer(data, np.uint8)
    for low in range(0, max(0, len(data) - min_bytes + 1), PIECE):
        piece = whole[low : low + PIECE + min_bytes - 1]
        hashes = RangeHashes(piece)
        grams = hashes.of_length(GRAM)
        ranked = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        smallest = (_window_minima(ranked, width) & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.diff(smallest, prepend=-1))
        last = np.append(first[1:], len(smallest)) - 1
        at, end = smallest[first], last + min_bytes
        shape = ((at - first) << 20 | (end - first)).astype(np.uint64)
        context = _mixed(hashes.of(first, end) ^ _mixed(shape))
        found.append((grams[at].view(np.int64), context.view(np.int64), first + low, end + low, at - first))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges with those that touch or overlap joined, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


POSTINGS = (
    "k1 bigint, k2 bigint, start bigint, end bigint, offset bigint, "
    "gram bigint, context bigint, times bigint"
)


def _postings(texts: DataFrame, min_bytes: int) -> DataFrame:
    """Entries of each text with their places.

    An entry that a text has more than once is listed once with its number; the bytes it covers
    there are repeated for certain and listed as ranges without an entry (`times` 0).
    """

    def index(batches):
        for batch in batches:
            keys = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(2)]
            columns: list[list[np.ndarray]] = [[] for _ in range(8)]
            for row, text in enumerate(batch.column(2)):
                gram, context, start, end, offset = suffix_entries(text.as_py(), min_bytes)
                if not len(gram):
                    continue
                both = np.stack([gram, context], axis=1)
                _, once, number, times = np.unique(
                    both, axis=0, return_index=True, return_inverse=True, return_counts=True
                )
                again = times[number.ravel()] > 1
                low, high = joined(start[again], end[again])
                none, zero = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
                parts = [start[once], end[once], offset[once], gram[once], context[once], times]
                rest = [low, high, none, none, none, zero]
                for at, key in enumerate(keys):
                    columns[at].append(np.full(len(once) + len(low), key[row], np.int64))
                for at, (part, more) in enumerate(zip(parts, rest), 2):
                    columns[at].append(np.concatenate([part, more]).astype(np.int64))
            names = [name.split()[0] for name in POSTINGS.split(", ")]
            arrays = [
                pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64))
                for parts in columns
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return texts.select(*KEY, F.col("text").cast("binary")).mapInArrow(index, POSTINGS)


@dataclass
class SuffixFamily:
    """Suffix arrays of 1, 2, 4, … batches as tables in the shared scratch folder."""

    spark: SparkSession
    levels: dict[int, str] = field(default_factory=dict)
    hits: list[str] = field(default_factory=list)

    def _stored(self, entries: DataFrame, name: str, sort: bool = True) -> str:
        path = scratch_path(self.spark, name)
        if sort:
            entries = entries.repartition("gram").sortWithinPartitions(*ENTRY)
        entries.write.parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def insert(self, postings: DataFrame) -> None:
        """Add a batch: note the grams it repeats, then merge it into the family."""
        entries = postings.groupBy(*ENTRY).agg(F.sum("times").alias("times"))
        path = self._stored(entries, "suffixes")
        new = self._read(path)
        repeated = new.groupBy("gram").agg(F.sum("times").alias("n")).filter("n > 1")
        scans = [repeated.select("gram")]
        for level in self.levels.values():
            scans.append(new.join(self._read(level), "gram", "left_semi").select("gram"))
        hits = reduce(DataFrame.unionByName, scans).distinct()
        self.hits.append(self._stored(hits, "suffix-hits", sort=False))
        merging, size = [path], 0
        while size in self.levels:
            merging.append(self.levels.pop(size))
            size += 1
        if len(merging) > 1:
            arrays = reduce(DataFrame.unionByName, map(self._read, merging))
            merged = arrays.groupBy(*ENTRY).agg(F.sum("times").alias("times"))
            path = self._stored(merged, "suffixes")
            for old in merging:
                remove_path(self.spark, old)
        self.levels[size] = path

    def repeated_entries(self) -> DataFrame:
        """`gram, context, times, contexts`: all entries of the grams that occur twice or more.

        `contexts` is the number of different contexts of the gram.
        """
        grams = self._read(self.hits[0])
        for path in self.hits[1:]:
            grams = grams.unionByName(self._read(path))
        arrays = reduce(DataFrame.unionByName, map(self._read, self.levels.values()))
        found = arrays.join(grams.distinct(), "gram", "left_semi")
        entries = found.groupBy(*ENTRY).agg(F.sum("times").alias("times"))
        counts = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"))
        return entries.join(counts, "gram")

    def remove(self) -> None:
        for path in [*self.levels.values(), *self.hits]:
            remove_path(self.spark, path)


def _context_windows(content: bytes, min_bytes: int) -> np.ndarray:
    return RangeHashes(np.frombuffer(content, np.uint8)).of_length(min_bytes)


def _covered(repeated: np.ndarray, min_bytes: int) -> list[dict[str, int]]:
    """Joined byte ranges of the strings that start where `repeated` is true."""
    starts = np.flatnonzero(repeated)
    low, high = joined(starts, starts + min_bytes)
    return [{"start": int(a), "end": int(b)} for a, b in zip(low, high)]


RANGES = "array<struct<start:int,end:int>>"
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _compared_in_tasks(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """`gram, context, ranges` of contexts (`content`), each gram's contexts side by side."""

    def compare(rows: list[tuple[int, int, bytes]]):
        windows = [_context_windows(content, min_bytes) for _, _, content in rows]
        values, number, counts = np.unique(
            np.concatenate(windows), return_inverse=True, return_counts=True
        )
        repeated, at = counts[number] > 1, 0
        for (gram, context, _), own in zip(rows, windows):
            ranges = _covered(repeated[at : at + len(own)], min_bytes)
            at += len(own)
            if ranges:
                yield gram, context, ranges

    def run(batches):
        group: list[tuple[int, int, bytes]] = []
        for batch in batches:
            found = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if group and group[0][0] != row[0]:
                    found += compare(group)
                    group = []
                group.append(row)
            yield _as_batch(found)
        if group:
            yield _as_batch(list(compare(group)))

    together = contexts.repartition("gram").sortWithinPartitions("gram")
    return together.mapInArrow(run, f"gram bigint, context bigint, ranges {RANGES}")


def _as_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), ()]
    kinds = [pa.int64(), pa.int64(), _RANGES]
    arrays = [pa.array(values, type=kind) for values, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["gram", "context", "ranges"])


def _compared_by_shuffle(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """The same with one row per string, counted with combining before the shuffle."""

    def list_windows(contents: pa.Array) -> pa.Array:
        rows = [_context_windows(content.as_py(), min_bytes).view(np.int64) for content in contents]
        return pa.array(rows, type=pa.list_(pa.int64()))

    def cover_batch(sizes: pa.Array, places: pa.Array) -> pa.Array:
        rows = []
        for size, starts in zip(sizes.to_pylist(), places.to_pylist()):
            repeated = np.zeros(size, bool)
            repeated[starts] = True
            rows.append(_covered(repeated, min_bytes))
        return pa.array(rows, type=_RANGES)

    windows = F.arrow_udf(list_windows, "array<bigint>")(F.col("content"))
    listed = contexts.select(*ENTRY, windows.alias("windows")).select(
        *ENTRY, F.size("windows").alias("size"), F.posexplode("windows").alias("at", "string")
    )
    repeated = (
        listed.groupBy("gram", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    starts = (
        listed.join(repeated, ["gram", "string"], "left_semi")
        .groupBy(*ENTRY, "size").agg(F.collect_set("at").alias("starts"))
    )
    covered = F.arrow_udf(cover_batch, RANGES)(F.col("size"), F.col("starts"))
    return starts.select(*ENTRY, covered.alias("ranges"))


def _contents(texts: DataFrame, places: DataFrame) -> DataFrame:
    """`gram, context, contexts, content` for places (`k1, k2, start, end`) in texts."""
    by_text = places.groupBy(*KEY).agg(
        F.collect_list(F.struct(*ENTRY, "contexts", "start", "end")).alias("places")
    )
    # Copies of a text are combined before the shuffle, so that a frequent text is few rows.
    once = texts.groupBy(*KEY).agg(F.first("text").alias("text"))
    held = once.join(by_text, KEY).select("text", "places")

    def cut(batches):
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for place in found.as_py():
                    content = data[place["start"] : place["end"]]
                    rows.append((place["gram"], place["context"], place["contexts"], content))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(values, type=kind) for values, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [*ENTRY, "contexts", "content"])

    return held.mapInArrow(cut, "gram bigint, context bigint, contexts bigint, content binary")


def repeated_spans(texts: DataFrame, min_bytes: int, batches: int = BATCHES) -> DataFrame:
    """`k1, k2, spans` of texts (`k1, k2, text`) with repeated strings: the ranges they cover."""
    if min_bytes < 2 * GRAM:
        raise ValueError(f"strings must have {2 * GRAM} bytes or more")
    spark = texts.sparkSession
    store = scratch_path(spark, "suffix-postings")
    placed = _postings(texts, min_bytes).withColumn("batch", F.pmod("k1", F.lit(batches)))
    placed.write.partitionBy("batch").parquet(store)
    schema = f"{POSTINGS}, batch int"
    postings = spark.read.schema(schema).parquet(store)
    indexed = postings.filter("times > 0")
    family = SuffixFamily(spark)
    for batch in range(batches):
        family.insert(indexed.filter(F.col("batch") == batch))
    entries_path = scratch_path(spark, "suffix-entries")
    family.repeated_entries().write.parquet(entries_path)
    family.remove()
    entries = spark.read.parquet(entries_path)

    # Contexts seen once whose gram has others: compare what they contain.
    mixed = entries.filter("contexts > 1")
    place = F.min(F.struct(*KEY, "start", "end")).alias("place")
    places = (
        indexed.join(mixed.select(*ENTRY, "contexts"), ENTRY)
        .groupBy(*ENTRY, "contexts").agg(place).select(*ENTRY, "contexts", "place.*")
    )
    contents_path = scratch_path(spark, "suffix-contexts")
    _contents(texts, places).write.parquet(contents_path)
    contents = spark.read.parquet(contents_path)
    few, many = (F.col("contexts") <= MAX_TOGETHER), (F.col("contexts") > MAX_TOGETHER)
    partly = _compared_in_tasks(
        contents.filter(few).select(*ENTRY, "content"), min_bytes
    ).unionByName(_compared_by_shuffle(contents.filter(many), min_bytes))
    wholly = entries.filter("times > 1").select(*ENTRY, F.lit(None).cast(RANGES).alias("ranges"))
    seen_twice = entries.filter("times > 1").select(*ENTRY)
    verdicts = wholly.unionByName(partly.join(seen_twice, ENTRY, "left_anti"))

    matched = indexed.join(verdicts, ENTRY)
    everything = F.array(F.struct(F.lit(0).alias("start"), (F.col("end") - F.col("start")).cast("int").alias("end")))
    ranges = matched.select(
        *KEY, "start", F.explode(F.coalesce("ranges", everything)).alias("range")
    ).select(
        *KEY,
        (F.col("start") + F.col("range.start")).alias("start"),
        (F.col("start") + F.col("range.end")).alias("end"),
    )
    own = postings.filter("times = 0").select(*KEY, "start", "end")
    gathered = ranges.unionByName(own).groupBy(*KEY).agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    spans_path = scratch_path(spark, "suffix-spans")
    gathered.write.parquet(spans_path)
    for path in (store, entries_path, contents_path):
        remove_path(spark, path)
    return spark.read.parquet(spans_path)


KEPT = "struct<spans:array<struct<start:bigint,end:bigint>>,kept:binary,n_bytes:bigint>"


def _kept(text: Column, spans: Column) -> Column:
    def cut_batch(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for text, ranges in zip(texts, found):
            data, places = text.as_py(), ranges.as_py() or []
            low, high = joined(
                np.array([place["start"] for place in places], np.int64),
                np.array([place["end"] for place in places], np.int64),
            )
            edges = [0, *np.stack([low, high], axis=1).ravel().tolist(), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            spans = [{"start": a, "end": b} for a, b in zip(low.tolist(), high.tolist())]
            rows.append({"spans": spans, "kept": kept, "n_bytes": len(data)})
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kind = [("spans", span), ("kept", pa.binary()), ("n_bytes", pa.int64())]
        return pa.array(rows, type=pa.struct(kind))

    return F.arrow_udf(cut_batch, KEPT)(text.cast("binary"), spans)


def readable(kept: Column) -> Column:
    """Kept bytes as text; what is left of a character that was cut in two goes."""

    def read_batch(contents: pa.Array) -> pa.Array:
        texts = [content.as_py().decode("utf-8", "ignore") for content in contents]
        return pa.array(texts, type=pa.string())

    return F.arrow_udf(read_batch, "string")(kept)


def remove_repeats(
    documents: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES, batches: int = BATCHES
) -> DataFrame:
    """Documents with `spans` (removed byte ranges), `kept` (the bytes left) and `n_bytes`."""
    prepare_workers(documents.sparkSession)
    content = whole_text(text)
    texts = documents.select(*text_key(content), content.alias("text"))
    spans = repeated_spans(texts, min_bytes, batches)
    names = {name: fresh_name(documents, name) for name in ("k1", "k2", "spans")}
    keyed = documents.withColumns(dict(zip((names["k1"], names["k2"]), text_key(content))))
    joined_spans = keyed.join(spans.withColumnsRenamed(names), [names["k1"], names["k2"]], "left")
    cut = fresh_name(documents, "cut")
    done = joined_spans.withColumn(cut, _kept(content, F.col(names["spans"])))
    results = {name: F.col(f"{cut}.{name}") for name in ("spans", "kept", "n_bytes")}
    dropped = [cut, names["k1"], names["k2"]]
    if names["spans"] != "spans":
        dropped.append(names["spans"])
    return with_results(done, results).drop(*dropped)
