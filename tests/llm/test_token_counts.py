import public_tokenizers
from tokenizers import Tokenizer

from tripgrain.llm.queries import op9_token_counts
from tripgrain.llm.token_counts import count_tokens, merge, merge_long

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
EDGES = [
    "", " a\n\n b  ", "x" * 5000, "日本語 𝔘𝔫𝔦 ² ½ ٣٤", "don't WE'VE\x1c\x85　z", "ΑΣ ΣΑΣ. İI ǅ ẞ",
    "a<|endoftext|>b<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "é Å", "ab" * 4000,
]


def library_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_rows_of_all_kinds(spark):
    texts = [None, *EDGES, EDGES[3], "word " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "N_TOKENS bigint, text string")
    for row in count_tokens(df.selectExpr("text", "N_TOKENS"), PATH).collect():
        assert row["n_tokens"] == library_count(row["text"])


def test_long_merges_equal_short_ones():
    ranks = {("a", "b"): 0, ("b", "a"): 1, ("ab", "ab"): 2, ("abab", "abab"): 3, ("b", "b"): 4}
    for text in ("ab" * 40, "aab" * 30, "abba" * 33 + "a", "b" * 77):
        assert merge_long(list(text), ranks) == merge(list(text), ranks)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "text string"), PATH).collect() == []


def test_query_against_the_library(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op9_token_counts(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == library_count(text)
        assert row["n_bytes"] == len(text.encode())
        assert row["over_limit"] == (row["n_tokens"] > 2048)
