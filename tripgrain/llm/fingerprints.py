"""One-permutation MinHash fingerprints of documents, in DataFrame expressions only.

Each shingle of five words is hashed once. The top bits of the hash choose a bin, and each bin keeps
its smallest hash. An empty bin borrows from a filled one that is found by a sequence of hashed
probes of its own (optimal densification), the same in every document. Of every bin the low 8
bits are kept and packed eight to a long. Two unrelated bins agree by chance once in 256, which
the likeness corrects for.

Words are runs without ASCII white space. A text of fewer than five words, but not none, is one
shingle. Defined results: NULL is the empty text; a text without words has an empty fingerprint,
which is like itself (1) and unlike any other (0); rows with equal ids and texts have equal
results; texts are read whole; result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.llm.columns import fresh_name, whole_text, with_results

BINS, KEPT_BITS, LANES = 256, 8, 8
SHINGLE_WORDS = 5
# Probes tried one after the other; bins that all of them miss take the filled bin whose hash with
# their own number is smallest, which is what an unbounded sequence of probes would choose.
PROBES = 12

_BIN_SHIFT = 64 - (BINS - 1).bit_length()
_EMPTY = (1 << _BIN_SHIFT) - 1
_BLANKS = " \t\n\x0b\x0c\r"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t-\r]+")
    )


def _shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles of a text of at least one word; `words` is a stored column."""
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    starts = F.sequence(F.lit(0), F.size(words) - SHINGLE_WORDS)
    shingles = F.transform(
        starts, lambda at: F.xxhash64(*[F.get(words, at + i) for i in range(SHINGLE_WORDS)])
    )
    return F.when(F.size(words) < SHINGLE_WORDS, whole).otherwise(shingles)


def _with_markers(hashes: Column) -> Column:
    """Sorted hashes with a marker behind those of each bin, so that every bin shows up."""
    markers = F.array(*[F.lit(_signed(place << _BIN_SHIFT | _EMPTY)) for place in range(BINS)])
    return F.sort_array(F.concat(hashes, markers))


def _lowest_of_bins(ordered: Column) -> Column:
    """The lowest hash of each bin without the bin's bits, NULL in empty bins.

    `ordered` is a stored column. Hashes are signed, so the bins of the upper half come first.
    """

    def first_of_bin(value: Column, at: Column) -> Column:
        before = F.get(ordered, at - 1)
        return (at == 0) | (F.shiftright(value, _BIN_SHIFT) != F.shiftright(before, _BIN_SHIFT))

    marker = F.lit(_EMPTY)
    return F.transform(
        F.filter(ordered, first_of_bin),
        lambda value: F.nullif(value.bitwiseAND(marker), marker),
    )


def _densified(bins: Column, filled: Column) -> Column:
    """Every bin with a value, if any has one; `bins` and `filled` are stored columns."""

    def value_of(value: Column, place: Column) -> Column:
        probes = [
            F.get(bins, F.hash(place, F.lit(probe)).bitwiseAND(F.lit(BINS - 1)))
            for probe in range(PROBES)
        ]
        nearest = F.array_min(
            F.transform(filled, lambda other: F.struct(F.xxhash64(place, other).alias("rank"), other.alias("place")))
        )
        borrowed = F.coalesce(*probes, F.get(bins, nearest["place"]))
        # Mixed with the borrower's number, so that one chance agreement is not borrowed by all.
        return F.coalesce(value, F.when(borrowed.isNotNull(), F.xxhash64(borrowed, place)))

    return F.transform(bins, value_of)


def _packed(bins: Column) -> Column:
    """The low bits of the bins, `LANES` to a long."""
    mask = F.lit((1 << KEPT_BITS) - 1).cast("bigint")

    def pack(group: Column) -> Column:
        lanes = [
            F.shiftleft(F.get(bins, group * LANES + lane).bitwiseAND(mask), KEPT_BITS * lane)
            for lane in range(LANES)
        ]
        packed = lanes[0]
        for lane in lanes[1:]:
            packed = packed.bitwiseOR(lane)
        return packed

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // LANES - 1)), pack)


def add_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """`df` with a column of packed longs, empty for a text without words.

    Every step is a column of its own, because lambdas read the previous ones many times.
    """
    kept = df.columns
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    df = df.withColumn("_words", _words(text))
    df = df.withColumn("_ordered", _with_markers(_shingle_hashes(F.col("_words"))))
    df = df.withColumn("_bins", _lowest_of_bins(F.col("_ordered")))
    df = df.withColumn(
        "_filled", F.filter(places, lambda place: F.get(F.col("_bins"), place).isNotNull())
    )
    df = df.withColumn("_full", _densified(F.col("_bins"), F.col("_filled")))
    nothing = F.array().cast("array<bigint>")
    packed = F.when(F.size("_words") > 0, _packed(F.col("_full"))).otherwise(nothing)
    return df.select(*[f"`{column}`" for column in kept], packed.alias(name))


def as_hex(packed: Column) -> Column:
    digits = F.transform(packed, lambda value: F.lower(F.lpad(F.hex(value), 16, "0")))
    return F.array_join(digits, "")


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, from 0 to 1."""
    mask = F.lit((1 << KEPT_BITS) - 1).cast("bigint")

    def agreeing(total: Column, difference: Column) -> Column:
        for lane in range(LANES):
            same = F.shiftright(difference, KEPT_BITS * lane).bitwiseAND(mask) == 0
            total = total + same.cast("int")
        return total

    differences = F.zip_with(one, other, lambda x, y: x.bitwiseXOR(y))
    agreed = F.reduce(differences, F.lit(0), agreeing) / F.lit(float(BINS))
    chance = 1.0 / (1 << KEPT_BITS)
    corrected = F.greatest(F.lit(0.0), (agreed - chance) / (1.0 - chance))
    return (
        F.when(one == other, 1.0)
        .when((F.size(one) == 0) | (F.size(other) == 0), 0.0)
        .otherwise(corrected)
    )


def fingerprint_documents(
    documents: DataFrame, text: str = "text", fingerprint: str = "fingerprint"
) -> DataFrame:
    """Documents with their fingerprint as packed longs."""
    name = fresh_name(documents, "packed")
    inner = documents.toDF(*[f"c{at}" for at in range(len(documents.columns))])
    place = f"c{documents.columns.index(text)}"
    marked = add_fingerprint(inner, whole_text(place), name)
    marked = marked.toDF(*documents.columns, name)
    return with_results(marked, {fingerprint: F.col(name)}).drop(name)


def following_documents(ids: DataFrame) -> DataFrame:
    """For distinct `id, tie` the `next_id, next_tie` in descending order, the first after the last.

    Rows are dealt out by range, so each part is ordered on its own; only the first row of each
    part, one per partition, is looked at together.
    """
    order = [F.desc("id"), F.desc("tie")]
    parts = ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = cut_lineage(parts)
    firsts = parts.groupBy("part").agg(F.max(F.struct("id", "tie")).alias("first"))
    all_parts = Window.orderBy("part")
    after = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(all_parts),
            F.first("first").over(
                all_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        ).alias("following"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    following = F.lead(F.struct("id", "tie")).over(inside)
    placed = parts.withColumn("inside", following).join(F.broadcast(after), "part")
    chosen = F.coalesce("inside", "following")
    return placed.select(
        *ids.columns, chosen["id"].alias("next_id"), chosen["tie"].alias("next_tie")
    )


def edited_neighbours(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document beside an edited text whose second half is the start of the next document.

    Columns `id, text, n_chars, edited, packed, packed_edited, packed_next`. The next document is
    the one of the next lower id, of the next tie among equal ids, and the first after the last.
    Identical rows count once in that order.
    """
    named = documents.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))
    named = named.withColumn("tie", F.xxhash64("text"))
    ids = named.select("id", "tie", F.char_length("text").alias("n_chars")).distinct()
    following = following_documents(ids).select(
        F.col("id").alias("for_id"),
        F.col("tie").alias("for_tie"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("taken"),
        "next_id",
        "next_tie",
    )
    marked = add_fingerprint(named, F.col("text"), "packed")
    heads = (
        marked.join(
            following,
            marked["id"].eqNullSafe(following["next_id"]) & (marked["tie"] == F.col("next_tie")),
        )
        .select(
            "for_id",
            "for_tie",
            F.substring("text", F.lit(1), F.col("taken")).alias("head"),
            F.col("packed").alias("packed_next"),
        )
        .dropDuplicates(["for_id", "for_tie"])
    )
    joined = marked.join(
        heads, marked["id"].eqNullSafe(heads["for_id"]) & (marked["tie"] == heads["for_tie"])
    )
    n_chars = F.char_length("text")
    kept = F.substring("text", F.lit(1), (n_chars - F.floor(n_chars / 2)).cast("int"))
    edited = joined.select(
        "id",
        "text",
        n_chars.cast("bigint").alias("n_chars"),
        F.concat(kept, "head").alias("edited"),
        "packed",
        "packed_next",
    )
    return add_fingerprint(edited, F.col("edited"), "packed_edited")
