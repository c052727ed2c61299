"""From raw documents to training tokens, in five stages.

Each stage takes `(spark, docs, sf_dir)`, works on everything its predecessor kept and returns a
DataFrame. All but the last return the columns of `documents`; between stages the rows are written
as Parquet and read again, so that a lost executor costs one stage at most.

1. `quality`: documents that the quality classifier rejects go. It is fitted to `labels`.
2. `near_duplicates`: of each SimHash class (three-word shingles, fingerprints linked at two or fewer
   differing bits) the document of the smallest id stays.
3. `repeats`: strings of `REPEAT_BYTES` bytes or more that occur more than once are cut out.
4. `benchmark`: documents that overlap `benchmark` by the contamination rule go.
5. `tokens`: each text as byte-level BPE ids, with the number of tokens and the digest of the
   decoded bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.durable import scratch_path
from tripgrain.llm.byte_bpe import decode_ids, encode_texts
from tripgrain.llm.columns import table
from tripgrain.llm.decontaminate import find_contamination, is_contaminated
from tripgrain.llm.quality import good_documents
from tripgrain.llm.simhash import keep_one_of_each
from tripgrain.llm.suffix_index import readable, remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE_WORDS = 3
# Shorter than nearly all passages of more than fifty words; one of very short words may be below it.
REPEAT_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose grade passes; NULL and empty texts are graded like any other."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash class; texts without words are one class, ties keep any one row."""
    return keep_one_of_each(docs, shingle_words=SHINGLE_WORDS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings. A character cut in two goes as a whole."""
    cut = remove_repeats(docs, min_bytes=REPEAT_BYTES)
    left = F.when(F.size("spans") == 0, F.col("text")).otherwise(readable(F.col("kept")))
    changed = cut.withColumn("text", left)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return changed.select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the contamination rule leaves; texts without words stay."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~is_contaminated()).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, NULL read as empty, and the digest of the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(docs, ranks, public_tokenizers.PATTERN)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("benchmark", benchmark),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# The stages hash, train and encode, which SQL cannot express.
ORACLE_SQL = None
