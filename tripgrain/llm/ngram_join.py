"""Documents that share most of their word shingles, joined exactly.

A document is the set of its distinct shingles, as sorted 64-bit hashes. Two sets of a and b hashes
whose Jaccard similarity is p percent or more differ in at most (a + b)(100 - p)/(100 + p) hashes.

*Tiles.* Sizes are cut in bands that double, and each band cuts the range of hashes into parts, with
about three hashes a part at the band's upper end. A part that is not empty is a token: its band,
place and content. Every differing hash spoils one part, so of more tokens than differences some
are shared, and with the tokens in the order of their places, a shared one stands among the first
D + 1 of either set, D being the differences that its size allows. A tile is the documents of a band
that have such a token in common. A set is in the tiles of its own band, and in those of the next
if larger partners may be there. The few sets that have too few tokens for that argument are dealt
out again by another hash.

*Bitmaps.* Each set has a bitmap of four to eight bits a hash, in which every hash flips its bit. A bit in
which two bitmaps differ stands for at least one hash that only one set has, so counting such bits
bounds the overlap from above. Laid over itself to one or two bits a hash it still rules out most
pairs, so what is moved for every tile is that rough one, and the whole one only for sets that it
leaves a partner. Only pairs that the bound lets pass are intersected, by search in the sorted
hashes, and hashes are listed only for such sets.

Only links between components matter. First each tile's sets are compared with its first one, which
settles tiles of two. Then, among the others of tiles that hold several components, every set
outside the largest is paired with the few most promising sets of other components. Found links
join components, and sets that had more candidates get more pairs in further rounds, until no
candidate is left unchecked. Tiles of over `CELL_BYTES` of bitmaps are dealt into pairs of blocks, which
are cells of bounded size, so that no tile has to fit a task and no pair is left out.

Defined results: words are maximal runs without ASCII white space, A-Z lowered; fewer words than a
shingle has are one shingle; a NULL text or one without words is the empty set and linked with
nothing; equal sets are one entry, whatever the number of their rows; rows with equal ids are
separate entries, a NULL id is never a class id unless all of the class are NULL; an empty table
gives an empty result; texts are read whole; other columns are not looked at. Hashes and the digest
that stands for a set have 64 bits.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage, scratch_path
from tripgrain.llm.columns import prepare_workers, whole_text
from tripgrain.llm.components import connected_components

SHINGLE_WORDS, MIN_PERCENT = 5, 80
LEAST_PARTS, HASHES_A_PART = 64, 3
# Pairs of a set in a cell in the first round, and times as many in each next one.
FIRST_PAIRS, MORE_PAIRS = 2, 8
# Times that groups are joined over their links before the next round's pairs.
LABEL_STEPS = 3
# Cells of more sets are compared as arrays.
FEW = 24
# Ids of sets to list are broadcast up to this number, 16 MB, and joined by shuffle beyond.
MAX_BROADCAST_IDS = 1_000_000
# After so many hashes a set is dealt out by single hashes, which always are tokens enough.
MAX_TRIES = 8
CELL_BYTES = 16 * 1024 * 1024
# Times that a rough bitmap is shorter, a power of two, and the words of 64 bits that it keeps.
ROUGH, ROUGH_WORDS = 4, 8
# Sets that a task remembers having dealt out, so that copies are dealt once.
MAX_REMEMBERED = 500_000

_ODD, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _S32)) * _SALT
    values = (values ^ (values >> _S29)) * _ODD
    return values ^ (values >> _S32)


def _salted(number: int) -> np.uint64:
    return np.uint64(number * int(_SALT) & (1 << 64) - 1)


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The set of a text: sorted distinct hashes of its shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    digests = b"".join(map(xxhash.xxh64_digest, found))
    hashed = np.frombuffer(digests, ">u8").astype(np.uint64)
    width = min(words, len(found))
    count = len(found) - width + 1
    chained = _mix(hashed[:count])
    for place in range(1, width):
        chained = _mix(chained * _ODD + hashed[place : place + count])
    chained.sort()
    return chained[np.concatenate(([True], chained[1:] != chained[:-1]))]


def set_id(hashes: np.ndarray) -> int:
    """A signed long that stands for the set."""
    digest = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return digest - (1 << 64) if digest >> 63 else digest


def band_of(size: int) -> int:
    return size.bit_length()


def tokens(hashes: np.ndarray, band: int, tries: int) -> np.ndarray:
    """The tokens of a set in the tiles of a band, in order of their places."""
    values = hashes if not tries else np.sort(_mix(hashes + _salted(tries)))
    place = values
    if tries < MAX_TRIES:
        parts = np.uint64(max(LEAST_PARTS, (1 << band) // HASHES_A_PART))
        place = ((values >> _S32) * parts) >> _S32
    starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    content = np.add.reduceat(_mix(values), starts)
    tile = _salted(band * (MAX_TRIES + 1) + tries + 1)
    return _mix(content ^ _mix(place[starts] + tile))


def tries_of(hashes: np.ndarray, percent: int) -> int:
    """The first way to deal out a set that gives it more tokens than it may have differences."""
    most = 2 * len(hashes) * (100 - percent) // (100 + percent)
    for tries in range(MAX_TRIES):
        if len(tokens(hashes, band_of(len(hashes)), tries)) > most:
            return tries
    return MAX_TRIES


def tile_keys(hashes: np.ndarray, percent: int, tries: int) -> np.ndarray:
    size = len(hashes)
    first = size * (100 - percent) // percent + 1
    bands = range(band_of(size), band_of(size * 100 // percent) + 1)
    return np.concatenate([tokens(hashes, band, tries)[:first] for band in bands])


def bitmap(hashes: np.ndarray) -> bytes:
    """The signature, in which every hash flips the bit of its low bits."""
    width = max(64, 4 << band_of(len(hashes)))
    flips = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((flips & 1).astype(bool), bitorder="little").tobytes()


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A bitmap with its halves laid over each other until it has `length` words."""
    while len(words) > length:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def rough(bits: bytes) -> bytes:
    """A bitmap laid over itself to one or two bits a hash, those of short sets to no fewer than 512 bits."""
    return folded(np.frombuffer(bits, np.uint64), max(ROUGH_WORDS, len(bits) // (8 * ROUGH))).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ, the longer one folded."""
    if len(a) < len(b):
        a, b = b, a
    one, other, width = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a)
    while width > 8 * len(b):
        width //= 2
        one = one >> width ^ one & (1 << width) - 1
    return (one ^ other).bit_count()


def overlap_bound(size_a: int, bits_a: bytes, size_b: int, bits_b: bytes) -> int:
    return (size_a + size_b - differing_bits(bits_a, bits_b)) // 2


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def enough(common: int, size_a: int, size_b: int, percent: int) -> bool:
    return common * (100 + percent) >= percent * (size_a + size_b)


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


LONGS = pa.list_(pa.int64())


def _sized(text: Column, words: int, percent: int) -> Column:
    """`node, size, tries, bits, rough` of the set of a text."""

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            hashes = shingle_hashes(text.as_py(), words)
            tries = tries_of(hashes, percent) if len(hashes) else 0
            bits = bitmap(hashes)
            rows.append((set_id(hashes), len(hashes), tries, bits, rough(bits)))
        columns = zip(*rows) if rows else ((), (), (), (), ())
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        return pa.StructArray.from_arrays(arrays, ["node", "size", "tries", "bits", "rough"])

    kind = "struct<node:bigint,size:bigint,tries:int,bits:binary,rough:binary>"
    return F.arrow_udf(run, kind)(text)


def _keyed(documents: DataFrame, words: int, percent: int, tries: int) -> DataFrame:
    """`key, node, own`: the tiles of every set; `own` tells sets that `tries` is the way of."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, counts, own = [], [], [], []
            for text in batch.column(0):
                hashes = shingle_hashes(text.as_py(), words)
                if not len(hashes):
                    continue
                node = set_id(hashes)
                if node in seen:
                    continue
                if len(seen) >= MAX_REMEMBERED:
                    seen.clear()
                seen.add(node)
                found = tile_keys(hashes, percent, tries)
                keys.append(found)
                nodes.append(node)
                counts.append(len(found))
                own.append(tries_of(hashes, percent) == tries if tries else True)
            together = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            arrays = [
                pa.array(together.view(np.int64)),
                pa.array(np.repeat(np.array(nodes, np.int64), counts)),
                pa.array(np.repeat(np.array(own, bool), counts)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "node", "own"])

    return documents.select("text").mapInArrow(run, "key bigint, node bigint, own boolean")


def _shared_runs(batches):
    """From rows sorted by key and node those of keys with several nodes, with the key's first.

    Nothing of a key is held but its first node and whether that was handed on.
    """
    key, first, last, told = None, None, None, False
    for batch in batches:
        keys, nodes = (column.to_numpy(zero_copy_only=False) for column in batch.columns[:2])
        if not len(keys):
            continue
        # A run may go on from the batch before, whose first and last node are put in front.
        goes_on = first is not None and keys[0] == key
        if goes_on:
            keys = np.concatenate(([key, key], keys))
            nodes = np.concatenate(([first, last], nodes))
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])))
        begins = np.concatenate(([True], keys[1:] != keys[:-1]))
        starts = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        several = np.maximum.reduceat(nodes, starts) != nodes[starts]
        hand_on = new & several[run]
        if goes_on:
            # What the batch before handed on: the first node if there was another, and the last.
            hand_on[0] &= not told
            hand_on[1] = False
        key, first, last = keys[-1], nodes[starts[-1]], nodes[-1]
        told = bool(several[-1])
        centers = nodes[starts][run]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[hand_on]) for column in (keys, nodes, centers)], ["key", "node", "center"]
        )


def may_be_similar(size_a: int, bits_a: bytes, size_b: int, bits_b: bytes, percent: int) -> bool:
    """False for pairs that sizes or bitmaps rule out."""
    small, large = sorted((size_a, size_b))
    return 100 * small >= percent * large and enough(
        overlap_bound(size_a, bits_a, size_b, bits_b), size_a, size_b, percent
    )


def _may_be_similar(percent: int):
    def run(*columns):
        rows = zip(*(column.to_pylist() for column in columns))
        return pa.array([may_be_similar(*row, percent) for row in rows], pa.bool_())

    return F.arrow_udf(run, "boolean")


def _is_similar(percent: int):
    def run(hashes_a, hashes_b):
        found = []
        for pair in zip(hashes_a, hashes_b):
            a, b = (_unsigned(value.values) for value in pair)
            found.append(enough(overlap(a, b), len(a), len(b), percent))
        return pa.array(found, pa.bool_())

    return F.arrow_udf(run, "boolean")


class Cell:
    """The sets of a tile, or of two of its blocks, in the order of their sizes."""

    def __init__(self, sets: list[tuple[int, int, int, int, bytes]], percent: int):
        """`sets` are `node, root, block, size, bits`."""
        self.sets = sorted(sets, key=lambda row: (row[3], row[0]))
        self.percent = percent
        self.nodes, roots, blocks, sizes, bits = map(list, zip(*self.sets))
        places = {root: place for place, root in enumerate(sorted(set(roots)))}
        self.root = [places[root] for root in roots]
        self.counts = [self.root.count(place) for place in places.values()] if len(places) < 9 else np.bincount(self.root).tolist()
        self.mixed = min(blocks) != max(blocks)
        self.many = len(sets) > FEW
        if self.many:
            self.roots, self.blocks, self.sizes = np.array(self.root), np.array(blocks), np.array(sizes)
            length = min(map(len, bits)) // 8
            words = [np.frombuffer(own, np.uint64) for own in bits]
            self.bits = np.stack([folded(own, length) for own in words])

    def near(self, at: int) -> list[tuple[int, int]]:
        """Sets of other components that may be similar, and the bits in which they differ.

        In a cell of two blocks only sets of different blocks are compared; others meet elsewhere.
        """
        if self.many:
            return self._near_of_many(at)
        _, _, block, size, bits = self.sets[at]
        found = []
        for other, (_, _, its_block, its_size, its_bits) in enumerate(self.sets):
            if self.root[other] == self.root[at] or (self.mixed and its_block == block):
                continue
            if 100 * min(size, its_size) >= self.percent * max(size, its_size):
                differing = differing_bits(bits, its_bits)
                if enough((size + its_size - differing) // 2, size, its_size, self.percent):
                    found.append((other, differing))
        return found

    def _near_of_many(self, at: int) -> list[tuple[int, int]]:
        size, percent = self.sizes[at], self.percent
        low = np.searchsorted(self.sizes, -(-percent * size // 100))
        high = np.searchsorted(self.sizes, 100 * size // percent, side="right")
        near = np.arange(low, high)
        near = near[self.roots[low:high] != self.roots[at]]
        if self.mixed:
            near = near[self.blocks[near] != self.blocks[at]]
        differing = np.bitwise_count(self.bits[near] ^ self.bits[at]).sum(axis=1, dtype=np.int64)
        total = self.sizes[near] + size
        passed = (total - differing) // 2 * (100 + percent) >= percent * total
        return list(zip(near[passed].tolist(), differing[passed].tolist()))

    def live(self) -> list[int]:
        """Sets that may be similar to another one."""
        return [node for at, node in enumerate(self.nodes) if self.near(at)]

    def pairs(self, most: int) -> list[tuple[int, int, bool]]:
        """For each set outside the largest component its `most` nearest of other ones.

        With them stands whether there were more.
        """
        found, largest = [], self.counts.index(max(self.counts))
        for at, root in enumerate(self.root):
            if root != largest:
                near = sorted((differing, self.nodes[other]) for other, differing in self.near(at))
                found += [(self.nodes[at], other, len(near) > most) for _, other in near[:most]]
        return found


def _in_cells(make, names: list[str], kinds: list):
    """Rows that `make` gives of each cell, from rows sorted by cell."""

    def run(batches):
        cell, held = None, []

        def found():
            rows = make(held) if len(held) > 1 else []
            columns = list(zip(*rows)) if rows else [()] * len(names)
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            numbers = zip(*(column.to_pylist() for column in batch.columns))
            for key, i, j, *row in numbers:
                if cell != (key, i, j):
                    if held:
                        yield found()
                    cell, held = (key, i, j), []
                held.append(tuple(row))
        if held:
            yield found()

    return run


def _cells(tiles: DataFrame, facts: DataFrame) -> DataFrame:
    """Tiles with several roots, dealt into cells; from `key, node, root` and `node, size, bits`.

    Bitmaps join the rows only when their cells are known, and so are moved once.
    """
    widths = facts.select("node", F.octet_length("bits").cast("bigint").alias("width"))
    width = F.sum("width").alias("width")
    several = tiles.join(widths, "node").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), width)
    blocks = several.filter("low < high").select(
        "key", F.ceil(F.col("width") / CELL_BYTES).cast("bigint").alias("blocks")
    )
    # Every two blocks meet in a cell, and each block meets itself.
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    dealt = tiles.join(blocks, "key").select("key", "node", "root", block, other)
    cells = dealt.join(facts, "node").select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "node", "root", "block", "size", "bits",
    )
    return cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _listed(documents: DataFrame, hashed: DataFrame, live: DataFrame, words: int) -> DataFrame:
    """`node, hashes` of live sets, from `id, text` of documents."""

    def run(batches):
        for batch in batches:
            sets = [shingle_hashes(text.as_py(), words) for text in batch.column(0)]
            nodes = pa.array([set_id(values) for values in sets], pa.int64())
            hashes = pa.array([values.view(np.int64) for values in sets], LONGS)
            yield pa.RecordBatch.from_arrays([nodes, hashes], ["node", "hashes"])

    # One document for each set. Others that have its id are hashed, too, and left out after.
    ids = cut_lineage(hashed.join(live, "node").groupBy("node").agg(F.min("id").alias("one"))).select("one").distinct()
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = documents.join(ids, F.col("id").eqNullSafe(F.col("one")), "left_semi").select("text")
    listed = texts.mapInArrow(run, "node bigint, hashes array<bigint>")
    return listed.join(live, "node", "left_semi").dropDuplicates(["node"])


def _hooked(links: DataFrame) -> DataFrame:
    """`node, root` of all linked nodes: two steps to the smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("step")
    )
    further = near.select(F.col("node").alias("step"), F.col("step").alias("root"))
    return near.join(further, "step").select("node", "root")


def _labels(links: DataFrame) -> DataFrame:
    """`node, known_root`: nodes of the same root are joined by links, those of others may be.

    After each step links are drawn between the roots instead. A few steps join most groups whole;
    what they leave apart costs pairs in the next round, but no link.
    """
    labels = cut_lineage(_hooked(links))
    for _ in range(LABEL_STEPS - 1):
        rest = links
        for end in ("a", "b"):
            rest = rest.join(labels.toDF(end, f"root_{end}"), end)
        rest = rest.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        rest = rest.filter("a <> b").distinct()
        higher = _hooked(rest).toDF("root", "higher")
        labels = cut_lineage(
            labels.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
        )
    return labels.withColumnRenamed("root", "known_root")


def similar_links(
    documents: DataFrame, hashed: DataFrame, tries: list[int], words: int, percent: int
) -> DataFrame:
    """Links `a, b` between sets whose components are those of all pairs that are similar enough.

    From `id, text` of documents and `id, node, size, bits, rough` of their sets.
    """
    spark = documents.sparkSession
    parts = []
    for way in tries:
        keyed = _keyed(documents, words, percent, way)
        if way:
            keyed = keyed.join(keyed.filter("own").select("key").distinct(), "key", "left_semi")
        dealt = keyed.select("key", "node").repartition("key").sortWithinPartitions("key", "node")
        parts.append(dealt.mapInArrow(_shared_runs, "key bigint, node bigint, center bigint"))
    tiles_path = scratch_path(spark, "ngram-tiles")
    reduce(DataFrame.unionByName, parts).select("key", "node").write.parquet(tiles_path)
    tiles = spark.read.parquet(tiles_path)

    def facts_of(sets: DataFrame, bits: str) -> DataFrame:
        return sets.groupBy("node").agg(F.first("size").alias("size"), F.first(bits).alias("bits"))

    def passed(pairs: DataFrame, facts: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(facts.toDF(end, f"size_{end}", f"bits_{end}"), end)
        may_be = _may_be_similar(percent)("size_a", "bits_a", "size_b", "bits_b")
        return cut_lineage(pairs.filter(may_be).select("a", "b"))

    facts = facts_of(hashed, "rough")

    # Every tile's first set against all of it, and the others among each other.
    ends = cut_lineage(
        tiles.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n"))
    )
    others = tiles.join(ends, "key").filter("low < node")
    pairs = others.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    first = passed(pairs, facts)
    middle = cut_lineage(others.filter("n > 2").select("key", "node"))

    # Sets that a rough bitmap leaves a partner, and the tiles and whole bitmaps of these.
    alone = _cells(middle.withColumn("root", F.col("node")), facts)
    found = alone.mapInArrow(
        _in_cells(lambda sets: [(node,) for node in Cell(sets, percent).live()], ["node"], [pa.int64()]),
        "node bigint",
    )
    ends_live = first.select(F.explode(F.array("a", "b")).alias("node"))
    live = cut_lineage(found.unionByName(ends_live).distinct())
    facts = cut_lineage(facts_of(hashed.join(live, "node", "left_semi"), "bits"))
    first = passed(first, facts)
    middle = cut_lineage(middle.join(live, "node", "left_semi"))
    sets_path = scratch_path(spark, "ngram-sets")
    _listed(documents, hashed, live, words).write.parquet(sets_path)
    sets = spark.read.parquet(sets_path)

    def verified(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("hashes").alias(f"hashes_{end}")), end)
        return cut_lineage(pairs.filter(_is_similar(percent)("hashes_a", "hashes_b")).select("a", "b"))

    links = verified(first)
    most = FIRST_PAIRS
    while True:
        rooted = middle.join(_labels(links), "node", "left").select(
            "key", "node", F.coalesce("known_root", "node").alias("root")
        )
        make = _in_cells(
            lambda sets, most=most: Cell(sets, percent).pairs(most),
            ["a", "b", "more"], [pa.int64(), pa.int64(), pa.bool_()],
        )
        promising = cut_lineage(
            _cells(rooted, facts).mapInArrow(make, "a bigint, b bigint, more boolean")
            .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.max("more").alias("more"))
        )
        links = links.unionByName(verified(promising.select("a", "b")))
        if promising.filter("more").isEmpty():
            return links
        most *= MORE_PAIRS


def jaccard_classes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    min_percent: int = MIN_PERCENT,
) -> DataFrame:
    """`id_column`, `n_shingles` and `component_id`, the smallest id of the class; a row per document.

    Two documents are linked if their sets have a Jaccard similarity of `min_percent` or more.
    """
    prepare_workers(documents.sparkSession)
    read = documents.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))
    hashed = cut_lineage(
        read.select("id", _sized(F.col("text"), shingle_words, min_percent).alias("set")).select("id", "set.*")
    )
    # A handful of numbers at most.
    tries = {row["tries"] for row in hashed.select("tries").distinct().collect()}
    entries = hashed.filter("size > 0")
    links = similar_links(read, entries, sorted({0, *tries}), shingle_words, min_percent)
    roots = connected_components(links)
    smallest = entries.groupBy("node").agg(F.min("id").alias("smallest"))
    placed = cut_lineage(
        smallest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    least = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = placed.select("node", "root").join(least, "root").drop("root")
    linked = entries.join(classes, "node").select("id", "size", "component_id")
    alone = hashed.filter("size = 0").select("id", "size", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), F.col("size").alias("n_shingles"), "component_id"
    )
