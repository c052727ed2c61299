"""Audit of how far the sources of a language differ in their words.

Texts are read as UTF-8 bytes. One translate table lowers A-Z, keeps a-z and every byte above 0x7F,
and blanks all others, so `bytes.translate` and `bytes.split` give the terms, and a `Counter` of
each document gives its frequencies. A task adds them up by (lang, source), with the number of
documents that hold a term, and hands on partial sums; Spark adds those up. What is shuffled is a
row for each term, source and share of a task, not the words.

Only counts above zero are stored. Terms that neither of two sources has all add the same amount to
their divergence, so it is added once, times their number. The rest is summed over the counts that
occur and over the terms that both sources have.

All arithmetic is on integers: products that may exceed 64 bits are decimals without digits behind
the point, and quotients are cut by `div`.

Defined results: NULL text, lang or source is the empty string; documents without terms still make
their (lang, source) occur; a language without kept terms has the divergence 0 between its sources
and no `term` rows; ties are put in order by the UTF-8 bytes of the item; every repeated row counts
again; texts of any length are read whole, one at a time; other columns are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.durable import scratch_path
from tripgrain.llm.columns import prepare_workers

MIN_DOCUMENTS, TOP_TERMS, UNIT = 10, 10, 1_000_000_000
# A task hands on its sums when they have so many terms or bytes.
MAX_HELD_TERMS, MAX_HELD_BYTES = 600_000, 32 * 1024 * 1024
_ROWS = 50_000

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte in _LETTERS or byte > 0x7F else 0x20
    for byte in range(256)
)
SUMS = "lang string, source string, term binary, occurrences bigint, documents bigint"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order."""
    return text.translate(TABLE).split()


class _Sums:
    """Frequencies and document counts by (lang, source).

    A frequency is the number of documents plus what a document holds beyond one.
    """

    def __init__(self):
        self.by_group: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = self.bytes = self.read = 0

    def add(self, group: tuple[str, str], text: bytes) -> None:
        found = Counter(terms(text))
        documents, beyond = self.by_group.setdefault(group, (Counter(), Counter()))
        before = len(documents)
        documents.update(found.keys())
        for term, count in found.items():
            if count > 1:
                beyond[term] += count - 1
        self.size += len(documents) - before
        self.read += len(text)
        if self.read >= MAX_HELD_BYTES:
            self.read = 0
            self.bytes = sum(sum(map(len, held)) for held, _ in self.by_group.values())

    @property
    def full(self) -> bool:
        return self.size >= MAX_HELD_TERMS or self.bytes >= MAX_HELD_BYTES

    def batches(self):
        """The sums as rows; each group also has one row without a term."""
        for (lang, source), (documents, beyond) in self.by_group.items():
            terms_held, held, more = list(documents), list(documents.values()), beyond.get
            occurrences = [count + more(term, 0) for term, count in documents.items()]
            for at in range(0, max(1, len(held)), _ROWS):
                part = slice(at, at + _ROWS)
                lead = [None] if at == 0 else []
                rows = len(terms_held[part]) + len(lead)
                arrays = [
                    pa.array([lang], pa.string()).take(pa.array([0] * rows)),
                    pa.array([source], pa.string()).take(pa.array([0] * rows)),
                    pa.array(lead + terms_held[part], pa.binary()),
                    pa.array([0 for _ in lead] + occurrences[part], pa.int64()),
                    pa.array([0 for _ in lead] + held[part], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [name.split()[0] for name in SUMS.split(", ")])
        self.__init__()


def _add_up(batches):
    sums = _Sums()
    for batch in batches:
        for lang, source, text in zip(*batch.columns):
            sums.add((lang.as_py(), source.as_py()), text.as_py())
            if sums.full:
                yield from sums.batches()
    yield from sums.batches()


def term_counts(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """`lang, source, term, occurrences, documents`, and a row with a NULL term for each group."""
    prepare_workers(documents.sparkSession)
    read = [
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)
        for name, alias in ((lang, "lang"), (source, "source"), (text, "text"))
    ]
    partial = documents.select(*read).withColumn("text", F.col("text").cast("binary"))
    added = partial.mapInArrow(_add_up, SUMS).groupBy("lang", "source", "term")
    return added.agg(
        F.sum("occurrences").alias("occurrences"), F.sum("documents").alias("documents")
    ).withColumn("term", F.col("term").cast("string"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept))."""
    exact = "decimal(38,0)"
    above = F.lit(UNIT).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)"))
    below = total.cast(exact) + F.lit(2).cast("decimal(1,0)") * kept.cast("decimal(20,0)")
    return (1 + F.call_function("div", above.cast(exact), below.cast(exact))).cast("bigint")


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """`lang, source, part, item, value, rank`: the sources' divergences and most typical terms.

    Part `pair` has every other source of the language by divergence, `term` the `top_terms` terms
    that are more frequent in the source than in the language, by their share of its divergence
    from the language. The term counts are written once to the shared scratch folder.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "term-counts")
    term_counts(documents, text, lang, source).write.parquet(path)
    counted = spark.read.parquet(path)

    in_lang = counted.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("occurrences").alias("lang_count"), F.sum("documents").alias("documents")
    )
    words_path = scratch_path(spark, "vocabulary")
    in_lang.filter(F.col("documents") >= min_documents).drop("documents").write.parquet(words_path)
    vocabulary = spark.read.parquet(words_path)
    kept_path = scratch_path(spark, "kept-terms")
    counted.drop("documents").join(vocabulary, ["lang", "term"]).write.parquet(kept_path)
    kept = spark.read.parquet(kept_path)

    # One row per language, and one per source.
    langs = vocabulary.groupBy("lang").agg(
        F.count(F.lit(1)).alias("V"), F.sum("lang_count").alias("lang_total")
    )
    totals = kept.groupBy("lang", "source").agg(
        F.sum("occurrences").alias("total"), F.count(F.lit(1)).alias("present")
    )
    groups = (
        counted.select("lang", "source").distinct()
        .join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["V", "lang_total", "total", "present"])
    )
    shares = _shares(kept, groups)
    return _pairs(shares, groups).unionByName(_typical(shares, top_terms))


def _shares(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept terms of each source with its share `p`, its share `none` of absent terms, and `q`."""
    V, total = F.col("V"), F.col("total")
    return kept.join(groups.filter("V > 0"), ["lang", "source"]).select(
        "lang", "source", "term",
        _share(F.col("occurrences"), total, V).alias("p"),
        _share(F.lit(0), total, V).alias("none"),
        _share(F.col("lang_count"), F.col("lang_total"), V).alias("q"),
    )


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    none = F.when(F.col("V") > 0, _share(F.lit(0), F.col("total"), F.greatest("V", F.lit(1))))
    own = groups.select("lang", "source", "V", "present", none.alias("none"))
    other = own.select("lang", F.col("source").alias("item"), F.col("present").alias("item_present"), F.col("none").alias("item_none"))
    pairs = own.join(other, "lang").filter("source <> item")

    # One side has the term, with the shares that occur, and the other is taken not to.
    values = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    alone = values.join(pairs, ["lang", "source"]).groupBy("lang", "source", "item").agg(
        F.sum(F.col("n") * _gap(F.col("p"), F.col("item_none"))).alias("alone")
    )
    # What terms of both sides add beyond that. Sums are formed before the shuffle.
    right = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("none").alias("item_none"))
    p, r, absent, item_absent = F.col("p"), F.col("r"), F.col("none"), F.col("item_none")
    more = _gap(p, r) - _gap(p, item_absent) - _gap(absent, r) + _gap(absent, item_absent)
    both = shares.join(right, ["lang", "term"]).filter("source < item").groupBy(
        "lang", "source", "item"
    ).agg(F.sum(more).alias("both"))
    mirrored = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "both")
    theirs = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_item"))
    keys = ["lang", "source", "item"]
    joined = (
        pairs.join(alone, keys, "left").join(theirs, keys, "left")
        .join(both.unionByName(mirrored), keys, "left")
        .na.fill(0, ["alone", "alone_item", "both"])
    )
    neither = (F.col("V") - F.col("present") - F.col("item_present")) * _gap(absent, item_absent)
    value = F.when(F.col("V") > 0, F.col("alone") + F.col("alone_item") + F.col("both") + neither)
    scored = joined.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce(value, F.lit(0)).cast("bigint").alias("value"))
    return scored.withColumn("rank", F.row_number().over(_by_value()))


def _by_value():
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))


def _typical(shares: DataFrame, top_terms: int) -> DataFrame:
    above = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _gap(F.col("p"), F.col("q")).cast("bigint").alias("value"),
    )
    # Spark keeps each task's first rows of a window before it shuffles them.
    return above.withColumn("rank", F.row_number().over(_by_value())).filter(F.col("rank") <= top_terms)
