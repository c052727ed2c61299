import sys
from pathlib import Path

import pytest
import tiktoken

import public_tokenizers

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_decontaminate import brute as overlap  # noqa: E402
from test_simhash import plain_components, plain_fingerprint  # noqa: E402
from test_suffix_index import brute as repeated  # noqa: E402
from tripgrain.llm.byte_bpe import read_ranks  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, rows = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    rows.append((docs.columns, docs.collect()))
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, spark.createDataFrame(rows[-1][1], docs.schema), sf_dir)
        rows.append((frame.columns, frame.collect()))
    return rows


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "tokens"]
    assert all(columns == stages[0][0] for columns, _ in stages[1:-1])


def test_quality_rejects_what_is_rated_bad(spark, sf_dir, stages):
    kept = {r["doc_id"] for r in stages[1][1]}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    right = [(r["doc_id"] in kept) == (r["quality"] == 1) for r in labels]
    assert sum(right) / len(right) > 0.97


def test_one_of_each_class_stays(stages):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in stages[1][1]}
    assert sorted(r["doc_id"] for r in stages[2][1]) == sorted(set(plain_components(prints).values()))


def test_repeats_are_cut(stages):
    before = stages[2][1]
    after = {r["doc_id"]: r for r in stages[3][1]}
    expected = repeated([r["text"] for r in before], corpus_pipeline.REPEAT_BYTES)
    assert len(after) == len(before)
    for row, (_, removed, _, kept) in zip(before, expected):
        text = after[row["doc_id"]]["text"]
        assert text == kept.decode("utf-8", "ignore")
        assert after[row["doc_id"]]["n_chars"] == (len(text) if text is not None else 0)


def test_contaminated_documents_go(spark, sf_dir, stages):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = set()
    for row in stages[3][1]:
        n_words, n_hit, _ = overlap(row["text"], items)
        if not (n_hit > 0 and 20 * n_hit >= n_words):
            expected.add(row["doc_id"])
    assert {r["doc_id"] for r in stages[4][1]} == expected


def test_tokens_and_run(spark, sf_dir, stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = read_ranks(lines.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stages[4][1]}
    assert {r["doc_id"]: r["ids"] for r in stages[5][1]} == {i: library.encode_ordinary(t) for i, t in texts.items()}
    assert sorted(map(repr, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(repr, stages[5][1]))


def test_odd_rows_pass_all_stages(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 60_000, "en", "s", 1)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, docs, sf_dir)
            docs = spark.createDataFrame(frame.collect(), frame.schema)
        assert docs.count() <= len(given)
