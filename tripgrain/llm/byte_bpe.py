"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

For every prefix of a byte string exactly one token can be the last one of its encoding. It is the
vocabulary suffix whose seam with the last token before it is stable: merging the bytes of both
gives the two back. Storing that token for each prefix encodes in one pass from left to right,
gives the encoding of every prefix on the way, makes appends exact, and lets an edit recompute
only from where it begins until the table agrees with the old one again.

Defined results: NULL and empty texts have no ids; NULL ids decode to no bytes, a NULL or unknown
id raises; rows, repeated ones included, are treated one by one; result columns replace input
columns of the same name. Texts of any length are encoded whole: time and memory are linear in it.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm.columns import bounded_broadcast, whole_text, with_results
from tripgrain.llm.pretokens import splitter

# What a worker remembers at most; beyond that it forgets what it has not met for long.
MAX_CACHED_PIECES = 200_000
MAX_CACHED_SEAMS = 200_000
# Tables of beginnings of so many bytes are kept, so that a piece goes on from a known prefix.
HEAD_BYTES, MAX_CACHED_HEADS = (6, 3), 30_000
# Pairs of ids as one number.
SEAM_BASE = 1 << 32


def read_ranks(payload: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines `base64 rank` of a rank file."""
    lines = (line.split() for line in payload.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class PrefixEncoder:
    """Encodes byte strings with a merge-rank vocabulary in which every single byte is a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        # Tokens that their own bytes merge into, each with the two tokens of its last merge.
        self.halves: dict[bytes, tuple[bytes, ...]] = {}
        for token in ranks:
            parts = tuple(self._merged_before(token))
            if len(parts) <= 2:
                self.halves[token] = parts
        self.ids = {token: ranks[token] for token in self.halves}
        self.token_of = {rank: token for token, rank in self.ids.items()}
        self.longest = max(map(len, self.halves))
        self._seams: dict[int, bool] = {}
        self._heads: dict[bytes, tuple[list[int], int]] = {}
        self._build_endings()

    def _build_endings(self) -> None:
        """An automaton whose state after some bytes tells all tokens that end there.

        A state is the longest beginning of a token that the bytes end in. `_steps` leads from
        `state << 8 | byte` to the next one, `_shorter` to the next shorter beginning, and `_endings`
        has the length and id of each token that ends there, the longest first.
        """
        steps, origin, ids = {}, [(0, 0)], [(0, -1)]
        for token, rank in self.ids.items():
            state = 0
            for byte in token:
                key = state << 8 | byte
                state = steps.get(key, 0)
                if not state:
                    state = steps[key] = len(origin)
                    origin.append((key, ids[key >> 8][0] + 1))
                    ids.append((origin[-1][1], -1))
            ids[state] = (len(token), rank)
        shorter, endings = [0] * len(origin), [()] * len(origin)
        for state in sorted(range(1, len(origin)), key=lambda state: origin[state][1]):
            before, byte = divmod(origin[state][0], 256)
            if before:
                back = shorter[before]
                while back and back << 8 | byte not in steps:
                    back = shorter[back]
                shorter[state] = steps[back << 8 | byte]
            own = (ids[state],) if ids[state][1] >= 0 else ()
            endings[state] = own + endings[shorter[state]] if own else endings[shorter[state]]
        self._steps, self._shorter, self._endings = steps, shorter, endings

    def _state(self, data: bytes, end: int) -> int:
        """The automaton's state after `data[:end]`, for which one longest token of bytes is enough."""
        state = 0
        for byte in data[max(0, end - self.longest) : end]:
            while (found := self._steps.get(state << 8 | byte)) is None:
                state = self._shorter[state]
            state = found
        return state

    def merged(self, data: bytes) -> list[int]:
        """The encoding by the plain rule: merge the adjacent pair of lowest rank, repeatedly."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min(
                (ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)
            )
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[part] for part in parts]

    def _merged_before(self, token: bytes) -> list[bytes]:
        """The encoding of a token's bytes by the ranks below its own."""
        own, ranks = self.ranks[token], self.ranks
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min(
                (ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1)
            )
            if rank >= own:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _seam_holds(self, left: bytes, right: bytes) -> bool:
        """True if no merge across the seam comes before the merges that made the two tokens.

        The merges next to the seam are undone from the latest to the earliest. Tokens that
        touch while a merge of rank `undone` is still to come must not merge before it.
        """
        ranks = self.ranks
        undone = 1 << 60
        while True:
            if ranks.get(left + right, 1 << 60) < undone:
                return False
            left_rank = ranks[left] if len(left) > 1 else -1
            right_rank = ranks[right] if len(right) > 1 else -1
            if left_rank < 0 and right_rank < 0:
                return True
            # Among equal ranks the merge further left comes first, so the right one is undone
            # first, and a pair at the seam must then rank at or below it to have come earlier.
            if left_rank > right_rank:
                undone = left_rank
                left = self.halves[left][1]
            else:
                undone = right_rank + 1
                right = self.halves[right][0]

    def _stable(self, seam: int) -> bool:
        if len(self._seams) >= MAX_CACHED_SEAMS:
            self._seams.clear()
        left, right = divmod(seam, SEAM_BASE)
        known = self._seams[seam] = self._seam_holds(self.token_of[left], self.token_of[right])
        return known

    def extend(self, data: bytes, last: list[int], until: int | None = None) -> list[int]:
        """Complete the table of last tokens of `data`, of which `last` covers a prefix."""
        self._extend(data, last, until or len(data), self._state(data, len(last)))
        return last

    def _extend(self, data: bytes, last: list[int], until: int, state: int) -> int:
        """`extend` from the state after what `last` covers; returns the state at the end."""
        steps, shorter, endings, seams = self._steps, self._shorter, self._endings, self._seams
        for end in range(len(last) + 1, until + 1):
            byte = data[end - 1]
            while (found := steps.get(state << 8 | byte)) is None:
                state = shorter[state]
            state = found
            for length, token in endings[state]:
                start = end - length
                if not start:
                    break
                seam = last[start - 1] * SEAM_BASE + token
                stable = seams.get(seam)
                if stable or (stable is None and self._stable(seam)):
                    break
            last.append(token)
        return state

    def replace(
        self, data: bytes, last: list[int], start: int, end: int, new: bytes
    ) -> tuple[bytes, list[int]]:
        """The text and table after `data[start:end]` became `new`.

        An entry depends on the bytes and entries of one longest token before it, so as soon as
        that many entries in a row behind the edit are as before, so are all the rest.
        """
        edited = data[:start] + new + data[end:]
        table, shift, same = last[:start], len(new) - (end - start), 0
        state = self._state(edited, start)
        for at in range(start, len(edited)):
            state = self._extend(edited, table, at + 1, state)
            old = at - shift
            same = same + 1 if old >= end and table[-1] == last[old] else 0
            if same >= self.longest:
                return edited, table + last[old + 1 :]
        return edited, table

    def tokens(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        found, end = [], len(last)
        while end:
            found.append(last[end - 1])
            end -= len(self.token_of[found[-1]])
        return found[::-1]

    def encode(self, data: bytes) -> list[int]:
        table, state = self._known_prefix(data, HEAD_BYTES)
        self._extend(data, table, len(data), state)
        return self.tokens(table)

    def _known_prefix(self, data: bytes, lengths: tuple[int, ...]) -> tuple[list[int], int]:
        """The longest beginning of `data` of one of these lengths: a copy of its table, its state."""
        for place, length in enumerate(lengths):
            if length < len(data):
                head = data[:length]
                known = self._heads.get(head)
                if known is None:
                    table, state = self._known_prefix(head, lengths[place + 1 :])
                    known = table, self._extend(head, table, length, state)
                    if len(self._heads) >= MAX_CACHED_HEADS:
                        self._heads.clear()
                    self._heads[head] = known
                return known[0].copy(), known[1]
        return [], 0


class PieceIds(dict):
    """Ids of the pieces met lately, in two generations of bounded size.

    A full generation becomes the older one, whose pieces are taken over when they are met again.
    """

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = tuple(self.encoder.encode(piece.encode("utf-8", "surrogatepass")))
        if len(self) >= MAX_CACHED_PIECES // 2:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _piece_ids(payload: bytes) -> PieceIds:
    return PieceIds(PrefixEncoder(read_ranks(payload)))


@lru_cache(maxsize=2)
def _bytes_of_ids(payload: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(payload).items()}


def _shared_ranks(spark: SparkSession, ranks_path: str):
    return bounded_broadcast(spark, Path(ranks_path).read_bytes())


def encoded(spark: SparkSession, text: Column, ranks_path: str, pattern: str) -> Column:
    """`array<int>` of token ids of a text, each match of `pattern` encoded separately."""
    shared = _shared_ranks(spark, ranks_path)

    def encode_batch(texts: pa.Array) -> pa.Array:
        ids_of, split = _piece_ids(shared.value).__getitem__, splitter(pattern)
        rows = [
            np.fromiter(chain.from_iterable(map(ids_of, split(text.as_py()))), np.int32)
            for text in texts
        ]
        offsets = np.zeros(len(rows) + 1, np.int32)
        np.cumsum([len(row) for row in rows], out=offsets[1:])
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return F.arrow_udf(encode_batch, "array<int>")(text)


def decoded(spark: SparkSession, ids: Column, ranks_path: str) -> Column:
    """The bytes that token ids stand for."""
    shared = _shared_ranks(spark, ranks_path)

    def decode_batch(rows: pa.Array) -> pa.Array:
        bytes_of = _bytes_of_ids(shared.value).__getitem__
        # One row at a time becomes Python numbers, which take ten times the room.
        return pa.array(
            (b"".join(map(bytes_of, row.values.to_numpy().tolist())) for row in rows),
            type=pa.binary(),
        )

    return F.arrow_udf(decode_batch, "binary")(F.coalesce(ids, F.array().cast("array<int>")))


def encode_texts(
    documents: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Documents with a column of token ids."""
    spark = documents.sparkSession
    return with_results(documents, {ids: encoded(spark, whole_text(text), ranks_path, pattern)})


def decode_ids(
    documents: DataFrame, ranks_path: str, ids: str = "ids", decoded_text: str = "decoded"
) -> DataFrame:
    """Documents with a column of the bytes their ids stand for."""
    spark = documents.sparkSession
    return with_results(
        documents, {decoded_text: decoded(spark, F.col(f"`{ids}`"), ranks_path)}
    )
