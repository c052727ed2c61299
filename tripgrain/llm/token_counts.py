"""Token counts of texts by a word-end BPE vocabulary, with a shortcut for whole words.

Which vocabulary strings encode alone as one token is proven once, before any text is read, by
running the merges over each of them. A pre-token that is such a string counts as one token
without merging; only the rest is merged.

The tokenizer file fixes the steps, which are checked when it is read: special strings are cut out
of the raw text and count one token each; what lies between them is composed (NFC), has runs of
white space turned into a space, is lower-cased character by character, split by the pattern, and
each piece's UTF-8 bytes are merged with a word end behind the last byte.

Defined results: NULL and empty texts have zero tokens; every row is counted, repeated ones too;
texts are counted whole; result columns replace input columns of the same name.
"""

from __future__ import annotations

import json
import pickle
import re
import unicodedata
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.columns import bounded_broadcast, whole_text, with_results
from tripgrain.llm.pretokens import splitter

MAX_CACHED_PIECES = 1_000_000
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable characters of Latin-1 stand for themselves; the other bytes are numbered upwards
    from U+0100.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in printable}
    others = [byte for byte in range(256) if byte not in letters]
    letters |= {byte: chr(0x100 + at) for at, byte in enumerate(others)}
    return [letters[byte] for byte in range(256)]


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge the adjacent pair of lowest rank, the leftmost first, until none is left."""
    while len(symbols) > 1:
        rank, at = min(
            (ranks.get(pair, NEVER), at) for at, pair in enumerate(zip(symbols, symbols[1:]))
        )
        if rank == NEVER:
            break
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class WordVocabulary:
    """Vocabulary, merges, pattern and proven whole words of a tokenizer file."""

    def __init__(self, content: dict):
        model, splits = content["model"], content["pre_tokenizer"]["pretokenizers"]
        expected = {
            "normalizers": (
                [step["type"] for step in content["normalizer"]["normalizers"]],
                ["NFC", "Replace", "Lowercase"],
            ),
            "pretokenizers": ([step["type"] for step in splits], ["Split", "ByteLevel"]),
            "kept": ((splits[0]["behavior"], splits[0]["invert"]), ("Removed", True)),
            "model": ((model["type"], model["unk_token"]), ("BPE", None)),
        }
        for what, (found, wanted) in expected.items():
            if found != wanted:
                raise ValueError(f"{what}: {found} is not supported, only {wanted}")
        self.pattern = splits[0]["pattern"]["Regex"]
        self.word_end = model["end_of_word_suffix"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.specials = [token["content"] for token in content["added_tokens"]]
        self.letters = {byte: letter for byte, letter in enumerate(byte_letters())}
        self.whole = self._prove_whole_words(model["vocab"])

    def symbols(self, letters: str) -> list[str]:
        return [*letters[:-1], letters[-1] + self.word_end]

    def _prove_whole_words(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """The words, as text, whose bytes merge into one token."""
        bytes_of = {letter: byte for byte, letter in self.letters.items()}
        proven = set()
        for token in vocabulary:
            letters = token.removesuffix(self.word_end)
            if token.endswith(self.word_end) and letters and set(letters) <= bytes_of.keys():
                if len(merge(self.symbols(letters), self.ranks)) == 1:
                    try:
                        proven.add(bytes(bytes_of[letter] for letter in letters).decode())
                    except UnicodeDecodeError:  # part of a character, so never a whole piece
                        continue
        return frozenset(proven)


class PieceCounts(dict):
    """Numbers of tokens of pieces met so far. It starts anew when full, so it is bounded."""

    def __init__(self, vocabulary: WordVocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        vocabulary = self.vocabulary
        if piece in vocabulary.whole:
            count = 1
        else:
            letters = piece.encode("utf-8", "surrogatepass").decode("latin-1")
            symbols = vocabulary.symbols(letters.translate(vocabulary.letters))
            count = len(merge_long(symbols, vocabulary.ranks))
        if len(self) >= MAX_CACHED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = count
        return count


def merge_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """As `merge`; long pieces go through a queue of pairs, in time n log n."""
    if len(symbols) <= 48:
        return merge(symbols, ranks)
    from heapq import heapify, heappop, heappush

    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    queue = [
        (ranks[pair], at, *pair)
        for at, pair in enumerate(zip(symbols, symbols[1:]))
        if pair in ranks
    ]
    heapify(queue)
    while queue:
        _, at, left, right = heappop(queue)
        other = after[at]
        if symbols[at] != left or other < 0 or symbols[other] != right:
            continue
        symbols[at], symbols[other] = left + right, ""
        after[at] = after[other]
        if after[at] >= 0:
            before[after[at]] = at
        for start in (before[at], at):
            if start >= 0 and after[start] >= 0:
                pair = (symbols[start], symbols[after[start]])
                if pair in ranks:
                    heappush(queue, (ranks[pair], start, *pair))
    return [symbol for symbol in symbols if symbol]


@lru_cache(maxsize=2)
def _prepared(tokenizer_path: str) -> bytes:
    """The vocabulary with its proofs, made on the driver once."""
    content = json.loads(Path(tokenizer_path).read_text(encoding="utf-8"))
    return pickle.dumps(WordVocabulary(content))


@lru_cache(maxsize=2)
def _counter(payload: bytes):
    """A function that counts the tokens of a text."""
    vocabulary = pickle.loads(payload)
    counts, split = PieceCounts(vocabulary), splitter(vocabulary.pattern)
    count_of, specials = counts.__getitem__, vocabulary.specials
    longest_first = sorted(specials, key=len, reverse=True)
    cut = re.compile("|".join(map(re.escape, longest_first))).split if specials else None

    def count_plain(text: str) -> int:
        # White space only separates pieces, so its runs need not be turned into one space.
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(count_of, split(text.lower())))

    def count(text: str) -> int:
        if cut is None or not any(special in text for special in specials):
            return count_plain(text)
        parts = cut(text)
        return len(parts) - 1 + sum(map(count_plain, parts))

    return count


def count_tokens(
    documents: DataFrame, tokenizer_path: str, text: str = "text", n_tokens: str = "n_tokens"
) -> DataFrame:
    """Documents with the number of tokens of each text."""
    shared = bounded_broadcast(documents.sparkSession, _prepared(tokenizer_path))

    def count_batch(texts: pa.Array) -> pa.Array:
        return pa.array(map(_counter(shared.value), texts.to_pylist()), type=pa.int64())

    counted = F.arrow_udf(count_batch, "bigint")(whole_text(text))
    return with_results(documents, {n_tokens: counted})
