import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tripgrain.llm.byte_bpe import PrefixEncoder, decode_ids, encode_texts, read_ranks
from tripgrain.llm.queries import op1_byte_bpe

RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
EDGES = ["", "  a\n\n b   ", "x" * 5000, "日本語 𝔘𝔫𝔦 ² ½", "don't we've\x1c\x85　z", "é" * 999 + "🤖🤖"]


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS_PATH, "rb") as lines:
        return read_ranks(lines.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_prefix_table_gives_the_plain_merges(ranks):
    encoder, chance = PrefixEncoder(ranks), random.Random(1)
    for _ in range(300):
        data = bytes(chance.choice(b"abcd e\xc3\xa9.ththeinger") for _ in range(chance.randrange(40)))
        table = encoder.extend(data, [])
        assert encoder.tokens(table) == encoder.merged(data)
        cut = chance.randrange(len(data) + 1)
        assert encoder.tokens(table[:cut]) == encoder.merged(data[:cut])


def test_states_tell_every_token_that_ends_there(ranks):
    encoder, chance = PrefixEncoder(ranks), random.Random(3)
    data = bytes(chance.choice(b"abcd e\xc3\xa9.ththeing  ") for _ in range(400)) + b" " * 150 + b"ation" * 9
    for end in range(1, len(data) + 1):
        tails = [data[start:end] for start in range(max(0, end - encoder.longest), end)]
        expected = [(len(tail), encoder.ids[tail]) for tail in tails if tail in encoder.ids]
        assert list(encoder._endings[encoder._state(data, end)]) == expected


def test_appends_and_edits_equal_a_fresh_table(ranks):
    encoder, chance = PrefixEncoder(ranks), random.Random(2)
    data = b"the quick brown fox jumps over the lazy dog, and then some more " * 20
    table = encoder.extend(data, [])
    assert encoder.extend(data + b"tail", list(table)) == encoder.extend(data + b"tail", [])
    for _ in range(100):
        start = chance.randrange(len(data) + 1)
        end = min(len(data), start + chance.randrange(6))
        new = bytes(chance.choice(b"abc e") for _ in range(chance.randrange(5)))
        edited, changed = encoder.replace(data, table, start, end, new)
        assert edited == data[:start] + new + data[end:]
        assert changed == encoder.extend(edited, [])


def test_rows_of_all_kinds_round_trip(spark, library):
    texts = [None, *EDGES, EDGES[1], "word " * 30_000]
    rows = [(i, text, "kept") for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, IDS string")
    encoded = encode_texts(df, RANKS_PATH, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "text", "ids"]
    for row in decode_ids(encoded, RANKS_PATH).collect():
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    encoded = encode_texts(df, RANKS_PATH, public_tokenizers.PATTERN)
    assert decode_ids(encoded, RANKS_PATH).collect() == []


def test_query_against_the_library(spark, library, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op1_byte_bpe(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
