"""Find passages of benchmark items in documents with a generalised suffix automaton.

The words of all items, or of a block of items of bounded size, become one suffix automaton. A
document's words stream through it, and at each word the automaton gives the length of the longest
item passage that ends there. Words inside passages of `window` words or more are hit; an item
shorter than that, but not empty, has to occur whole.

Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z became lower case.

`remove_contamination` cuts hit passages out of the texts where they exceed a length or a coverage.

Defined results: NULL and empty texts have no words and no hits; an empty benchmark hits nothing;
a NULL text stays NULL when spans are removed; an empty table gives an empty result;
items without words match nothing; an item without an id hits words but is not listed; rows with
equal ids are separate documents, and items with equal ids are listed once; result columns replace
input columns of the same name. Texts are read whole.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.llm.columns import (
    bounded_broadcast,
    fresh_name,
    prepare_workers,
    whole_text,
    with_results,
)

WINDOW = 13
# An automaton of one block; larger benchmarks take several, over which the documents stream in
# turn. Longer items are cut into pieces that overlap by a window less one word.
BLOCK_WORDS = 100_000
PIECE_WORDS = 20_000

# Bytes of words stay, A-Z become lower case, all others separate words.
_IN_WORDS = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_WORD_BYTES = bytes(
    byte if byte in _IN_WORDS else byte + 32 if 0x41 <= byte <= 0x5A else 0x20
    for byte in range(256)
)

FOUND = "struct<n_words:bigint,hits:array<struct<start:int,end:int>>,items:array<string>>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class ItemAutomaton:
    """Generalised suffix automaton over word ids, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, words in items:
            sequence = [self.ids.setdefault(word, len(self.ids)) for word in words]
            sequences.append((item, sequence))
            last = 0
            for word in sequence:
                last = self._append(last, word)
        self._mark(sequences)

    def _state(self, length: int, link: int, steps: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.steps.append(steps)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the target's strings of at most one word more than `state` has."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.steps[target]))
        self.link[target] = clone
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = clone
            state = self.link[state]
        return clone

    def _append(self, last: int, word: int) -> int:
        known = self.steps[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.steps[last][word])
        return new

    def _mark(self, sequences) -> None:
        """Note the items at the states of their windows and, for short ones, at their ends."""
        states, window = len(self.length), self.window
        by_length = sorted(range(1, states), key=self.length.__getitem__)
        # The state of the last `window` words of what a state stands for.
        self.windows = [0] * states
        for state in by_length:
            if self.length[state] >= window:
                parent = self.link[state]
                self.windows[state] = (
                    self.windows[parent] if self.length[parent] >= window else state
                )
        self.items: dict[int, set[str]] = {}
        own: dict[int, tuple[int, set[str]]] = {}
        self.shortest = window
        for item, sequence in sequences:
            state, named = 0, {item} if item is not None else set()
            for at, word in enumerate(sequence):
                state = self.steps[state][word]
                if at + 1 >= window:
                    self.items.setdefault(self.windows[state], set()).update(named)
            if 0 < len(sequence) < window:
                own.setdefault(state, (len(sequence), set()))[1].update(named)
                self.shortest = min(self.shortest, len(sequence))
        # Short items by state, and for each state the nearest ancestor or self that has some.
        self.short, self.nearest = own, [0] * states
        for state in by_length:
            self.nearest[state] = state if state in own else self.nearest[self.link[state]]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit ranges of word positions, and the items found."""
        get = self.ids.get
        ids = np.array([get(word, -1) for word in words], np.int64)
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False]))))
        ranges: list[list[int]] = []
        items: set[str] = set()
        for start, end in known.reshape(-1, 2):
            if end - start >= self.shortest:
                self._search_run(ids[start:end].tolist(), int(start), ranges, items)
        return [(start, end) for start, end in ranges], items

    def _search_run(self, ids, offset: int, ranges: list[list[int]], items: set[str]) -> None:
        steps, link, length = self.steps, self.link, self.length
        windows, nearest, short, window = self.windows, self.nearest, self.short, self.window
        state = matched = 0
        for at, word in enumerate(ids, offset + 1):
            while state and word not in steps[state]:
                state = link[state]
                matched = length[state]
            if word in steps[state]:
                state = steps[state][word]
                matched += 1
            longest = 0
            if matched >= window:
                longest = matched
                items |= self.items[windows[state] if length[link[state]] >= window else state]
            ending = nearest[state]
            while ending:
                size, named = short[ending]
                if size <= matched:
                    longest = max(longest, size)
                    items |= named
                ending = nearest[link[ending]]
            if longest:
                start = at - longest
                while ranges and ranges[-1][1] >= start:
                    start = min(start, ranges.pop()[0])
                ranges.append([start, at])


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Distinct items as word sequences; long ones as overlapping pieces."""

    def cut(batches):
        for batch in batches:
            rows = []
            for name, content in zip(*(column.to_pylist() for column in batch.columns)):
                words = words_of(content)
                step = max(1, PIECE_WORDS - window + 1)
                for start in range(0, max(1, len(words) - window + 1), step):
                    piece = words[start : start + PIECE_WORDS]
                    if piece:
                        rows.append((name, b" ".join(piece), len(piece)))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            types = [pa.string(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=kind) for values, kind in zip(columns, types)],
                names=["item", "words", "n"],
            )

    named = benchmark.select(F.col(f"`{item}`").cast("string"), whole_text(text))
    pieces = named.toDF("item", "text").mapInArrow(cut, "item string, words binary, n bigint")
    return pieces.distinct()


def item_automata(benchmark: DataFrame, item: str, text: str, window: int) -> tuple[DataFrame, int]:
    """A stored table with one serialised automaton per block, and the number of blocks."""
    pieces = _pieces(benchmark, item, text, window)
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        items = [
            (None if pd.isna(name) else name, bytes(words).split(b" "))
            for name, words in zip(rows["item"], rows["words"])
        ]
        automaton = pickle.dumps(ItemAutomaton(items, window))
        return pd.DataFrame({"block": rows["block"].iloc[:1], "automaton": [automaton]})

    placed = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))))
    built = placed.groupBy("block").applyInPandas(build, "block bigint, automaton binary")
    return cut_lineage(built), blocks


@lru_cache(maxsize=1)
def _loaded(payload: bytes) -> ItemAutomaton:
    return pickle.loads(payload)


def _search_column(text: Column, shared) -> Column:
    def search_batch(texts: pa.Array) -> pa.Array:
        automaton = _loaded(shared.value) if shared else None
        found = []
        for text in texts.to_pylist():
            words = words_of(text)
            hits, items = automaton.search(words) if automaton else ([], set())
            spans = [{"start": start, "end": end} for start, end in hits]
            found.append({"n_words": len(words), "hits": spans, "items": sorted(items)})
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kind = [("n_words", pa.int64()), ("hits", span), ("items", pa.list_(pa.string()))]
        return pa.array(found, type=pa.struct(kind))

    return F.arrow_udf(search_batch, FOUND)(text)


def _joined_spans(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap joined."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        widened = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(widened))
        apart = F.concat(done, F.array(span))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(touches, joined).otherwise(apart)

    return F.reduce(F.array_sort(spans), empty, add)


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Documents with `n_words`, `n_hit`, `hits` (word ranges, end exclusive) and `items`."""
    spark = documents.sparkSession
    prepare_workers(spark)
    automata, blocks = item_automata(benchmark, item, item_text, window)
    found = fresh_name(documents, "found")
    scanned = documents
    for block in range(max(1, blocks)):
        row = automata.filter(F.col("block") == block).first()
        shared = bounded_broadcast(spark, bytes(row["automaton"])) if row else None
        column = f"{found}{block}"
        if block:
            # Stored between blocks, so that a worker never holds more than one automaton.
            scanned = cut_lineage(scanned)
        scanned = scanned.withColumn(column, _search_column(whole_text(text), shared))
    parts = [f"{found}{block}" for block in range(max(1, blocks))]
    hits = F.col(f"{parts[0]}.hits")
    items = F.col(f"{parts[0]}.items")
    if len(parts) > 1:
        hits = _joined_spans(F.flatten(F.array(*[F.col(f"{part}.hits") for part in parts])))
        items = F.array_distinct(F.flatten(F.array(*[F.col(f"{part}.items") for part in parts])))
    n_hit = F.reduce(
        hits, F.lit(0).cast("bigint"), lambda total, span: total + (span["end"] - span["start"])
    )
    results = {
        "n_words": F.col(f"{parts[0]}.n_words"),
        "n_hit": n_hit,
        "hits": hits,
        "items": F.array_sort(items),
    }
    return with_results(scanned, results).drop(*parts)


def _places_of(text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    """First byte of each word, the byte after it, and the text's bytes."""
    content = text.encode("utf-8", "surrogatepass")
    blank = np.frombuffer(content.translate(_WORD_BYTES), np.uint8) == 0x20
    edges = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1), content


def spans_to_remove(
    hits: list[tuple[int, int]], n_words: int, max_span: int, max_share: float
) -> list[tuple[int, int]]:
    """Hit ranges longer than `max_span` words; all of them if together they exceed `max_share`."""
    covered = sum(end - start for start, end in hits)
    if covered > max_share * n_words:
        return list(hits)
    return [(start, end) for start, end in hits if end - start > max_span]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges and what stands between the words of one range.

    What separates a range from the words around it stays, once: signs and blanks before it, or
    after it at the beginning of the text.
    """
    if not spans:
        return text
    starts, ends, content = _places_of(text)
    kept, at = [], 0
    for start, end in spans:
        kept.append(content[at : starts[start]])
        at = ends[end - 1]
        if end < len(starts) and start > 0:
            # Blanks before the range separate its neighbours already.
            while at < starts[end] and content[at] in b" \t" and kept[-1][-1:] in (b" ", b"\t", b"\n"):
                at += 1
    kept.append(content[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def remove_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_span: int = 0,
    max_share: float = 0.0,
) -> DataFrame:
    """Documents whose `text` lacks the hit passages that exceed the limits, and `n_removed` words.

    A passage goes if it is longer than `max_span` words, or if hit words are more than `max_share`
    of the document's words; by default every hit passage goes. Rows and other columns stay. What is
    hit is judged on the text as given, not on what is left.
    """
    # Packed, so that no column gives way to those of the search.
    packed = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    searched = find_contamination(packed, benchmark, "text", item, item_text, window)

    def cut(texts: pa.Array, hit: pa.Array) -> pa.Array:
        rows = []
        for content, row in zip(texts.to_pylist(), hit.to_pylist()):
            ranges = [(span["start"], span["end"]) for span in row["hits"]]
            spans = spans_to_remove(ranges, row["n_words"], max_span, max_share)
            left = None if content is None else without_spans(content, spans)
            rows.append({"text": left, "n_removed": sum(end - start for start, end in spans)})
        return pa.array(rows, pa.struct([("text", pa.string()), ("n_removed", pa.int64())]))

    found = fresh_name(documents, "found")
    left = F.arrow_udf(cut, "struct<text:string,n_removed:bigint>")(
        F.col("text"), F.struct("n_words", "hits")
    )
    cleaned = searched.select("row.*", left.alias(found))
    values = {text: F.col(f"{found}.text"), "n_removed": F.col(f"{found}.n_removed")}
    return with_results(cleaned, values).drop(found)


def is_contaminated(min_share: int = 20) -> Column:
    """True where hit words are at least one in `min_share` of all words."""
    return (F.col("n_hit") > 0) & (F.lit(min_share) * F.col("n_hit") >= F.col("n_words"))
