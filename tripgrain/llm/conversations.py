"""Repair of conversation structure by Knuth's lightest derivation.

The roles of a repaired conversation read `(system? (user assistant)+)?`. An item says that the first
rows of a conversation are dealt with and in which state the roles written so far are. The rules
derive items from items: keep, give another role to, or delete the next row, or insert a message
without text. A rule's value is that of its antecedent plus the edit's cost, with the edit's
initial behind its audit, so it is greater than its antecedent in the order (cost, audit): a superior
function. The agenda pops items in that order, each of which is final when popped, until the goal
item is.

Two audits of the same item at the same cost are never prefixes of each other, as what the longer
one has beyond the shorter would be inserts, which cost. So the order of audits survives what
follows them, and a conversation can be cut in pieces anywhere: a piece is the lightest derivation
from each state before it to each state after it, and adjacent pieces join like matrices.

Rows are dealt to tasks in ranges of (conversation, turn), so a conversation of any length is many
tasks' work. Conversations that lie inside a range are finished in one pass, in the memory of one
conversation of at most `HELD_ROWS` rows and `HELD_CHARS` characters. Those at an edge, and longer
ones, are worked on as tables: repeated messages are found by grouping, pieces of `PIECE_ROWS`
rows are derived where the rows lie, and joined by conversation. Only the digest of a repaired
conversation is one stream by its nature; its rows pass one task in order, a batch at a time.

Defined results: a NULL role or text is one space; a NULL turn comes first and is left out of
`gaps`; a NULL conversation is one of its own; rows of one turn are in the order of role and SHA-256
of the text, so equal rows are adjacent; an empty table gives an empty result; texts are read whole;
only the named columns are looked at, and results are named as below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.llm.columns import prepare_workers

SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
PIECE_ROWS, HELD_ROWS, HELD_CHARS = 64, 20_000, 32_000_000

# States of the roles written so far: nothing, a system message, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ACCEPTED = (NOTHING, ASSISTANT)
KEPT = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
# The state after a message whose role is free, and that role.
FREE = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
FREE_ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")

# What may be done with a row.
FINE, CUT_SHORT, MUST_GO = range(3)
Step = tuple[str, int, int]  # initial of the role, one of the above, number of rows
Value = tuple[int, str]


def is_blank(text: str) -> bool:
    return not text.strip(SPACE)


def is_truncated(text: str) -> bool:
    return text.rstrip(SPACE)[-1:] not in tuple(ENDS)


def _edits(state: int, step: Step) -> Iterator[tuple[int, int, str]]:
    """State after, cost and letters of all edits of a row."""
    initial, fault, rows = step
    yield state, DELETE * rows, "D" * rows
    if fault != MUST_GO:
        extra = TRUNCATED if fault == CUT_SHORT else 0
        kept = KEPT.get((state, initial))
        if kept is not None:
            yield kept, extra, "K"
        yield FREE[state], REROLE + extra, "R"


def lightest(steps: list[Step], start: int, goals: tuple[int, ...], first_only: bool) -> dict[int, Value]:
    """Lightest (cost, audit) from a state before `steps` to the goal states after them.

    With `first_only` the agenda ends when the lightest goal is final.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Value] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(steps) and state in goals:
            found[state] = (cost, audit)
            if first_only or len(found) == len(goals):
                break
        if (at, FREE[state]) not in final:
            heappush(agenda, (cost + INSERT, audit + "I", at, FREE[state]))
        if at < len(steps):
            for after, more, letters in _edits(state, steps[at]):
                if (at + 1, after) not in final:
                    heappush(agenda, (cost + more, audit + letters, at + 1, after))
    return found


@dataclass
class Piece:
    """Adjacent rows of a conversation: lightest values by states around them, and counts."""

    values: dict[tuple[int, int], Value]
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first_role: str
    last_role: str
    first_turn: int | None
    last_turn: int | None
    turns: int

    def then(self, other: Piece) -> Piece:
        values: dict[tuple[int, int], Value] = {}
        for (before, between), (cost, audit) in self.values.items():
            for (joint, after), (more, letters) in other.values.items():
                if joint == between:
                    value = (cost + more, audit + letters)
                    if values.get((before, after), (value[0] + 1, "")) > value:
                        values[before, after] = value
        met = self.last_role + other.first_role not in LEGAL
        shared = self.last_turn is not None and self.last_turn == other.first_turn
        return Piece(
            values,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + met,
            self.first_role,
            other.last_role,
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            self.turns + other.turns - shared,
        )

    @property
    def gaps(self) -> int:
        if self.first_turn is None:
            return 0
        return self.last_turn - self.first_turn + 1 - self.turns


class Pieces:
    """Joins pieces that come one after the other, sizes first alike, so little is copied twice."""

    def __init__(self):
        self.stack: list[tuple[int, Piece]] = []

    def add(self, piece: Piece) -> None:
        size = 1
        while self.stack and self.stack[-1][0] <= size:
            before, earlier = self.stack.pop()
            piece, size = earlier.then(piece), before + size
        self.stack.append((size, piece))

    def joined(self) -> Piece:
        piece = self.stack[-1][1]
        for _, earlier in reversed(self.stack[:-1]):
            piece = earlier.then(piece)
        return piece


# Turn, initial of the role, fault, number of rows, and of these duplicates, blanks, truncated.
Feature = tuple[int | None, str, int, int, int, int, int]


def features_of(turn: int | None, role: str, rows: int, blank: bool, seen: bool, cut_short: bool) -> list[Feature]:
    """`rows` equal rows, of which the first is blank, a duplicate, truncated, or neither."""
    initial = role[:1]
    if blank:
        return [(turn, initial, MUST_GO, rows, 0, rows, 0)]
    if seen:
        return [(turn, initial, MUST_GO, rows, rows, 0, 0)]
    first = (turn, initial, CUT_SHORT if cut_short else FINE, 1, 0, 0, int(cut_short))
    copies = [(turn, initial, MUST_GO, rows - 1, rows - 1, 0, 0)] if rows > 1 else []
    return [first, *copies]


def piece_of(features: list[Feature], values: dict[tuple[int, int], Value]) -> Piece:
    roles = [feature[1] for feature in features]
    # Rows counted together have the same role, and no two equal initials may meet.
    illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))
    illegal += sum(feature[3] - 1 for feature in features)
    turns = [feature[0] for feature in features if feature[0] is not None]
    return Piece(
        values,
        sum(feature[5] for feature in features),
        sum(feature[4] for feature in features),
        sum(feature[6] for feature in features),
        illegal,
        roles[0],
        roles[-1],
        turns[0] if turns else None,
        turns[-1] if turns else None,
        len(set(turns)),
    )


def _steps(features: list[Feature]) -> list[Step]:
    """The features as rows to edit; rows that must go are one step as long as they are adjacent."""
    steps: list[Step] = []
    for _, initial, fault, rows, *_ in features:
        if fault == MUST_GO and steps and steps[-1][1] == MUST_GO:
            steps[-1] = (steps[-1][0], MUST_GO, steps[-1][2] + rows)
        else:
            steps.append((initial, fault, rows))
    return steps


def derive(features: list[Feature]) -> Piece:
    """The piece of some rows: the agenda is run from each state."""
    steps = _steps(features)
    values = {
        (before, after): value
        for before in STATES
        for after, value in lightest(steps, before, _reachable(before), False).items()
    }
    return piece_of(features, values)


def _reachable(before: int) -> tuple[int, ...]:
    return {NOTHING: STATES, SYSTEM: (SYSTEM, USER, ASSISTANT)}.get(before, (USER, ASSISTANT))


def repaired(features: list[Feature]) -> tuple[Piece, Value]:
    """A whole conversation."""
    if len(features) <= PIECE_ROWS:
        found = lightest(_steps(features), NOTHING, ACCEPTED, True)
        return piece_of(features, {}), min(found.values())
    pieces = Pieces()
    for at in range(0, len(features), PIECE_ROWS):
        pieces.add(derive(features[at : at + PIECE_ROWS]))
    whole = pieces.joined()
    return whole, goal(whole)


def goal(whole: Piece) -> Value:
    return min(whole.values[NOTHING, state] for state in ACCEPTED if (NOTHING, state) in whole.values)


def replay(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of each message that an audit makes of the rows."""
    state, rest = NOTHING, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rest)
        if letter == "K":
            state = KEPT[state, role[:1]]
        elif letter != "D":
            state = FREE[state]
            role = FREE_ROLE[state]
        if letter != "D":
            yield role, text


class Digest:
    """SHA-256 of `role:text` lines."""

    def __init__(self):
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1


RESULTS = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)
_KINDS = [*[pa.int64()] * 6, pa.string(), pa.string()]


def _result(whole: Piece, value: Value, digest: str | None) -> tuple:
    counts = (whole.gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal)
    return (*counts, *value, digest)


def _as_batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    arrays = [pa.array(values, type=kind) for values, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _runs(batches, width: int) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of their first `width` columns, one batch at a time."""
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns[:width])):
            yield row


class _Held:
    """The rows of a conversation until it is known to be whole."""

    def __init__(self, most_rows: int):
        self.rows: list[tuple[int | None, str, str]] = []
        self.most_rows, self.chars, self.at_edge = most_rows, 0, False

    def add(self, turn: int | None, role: str, text: str) -> None:
        if self.at_edge:
            return
        self.rows.append((turn, role, text))
        self.chars += len(role) + len(text)
        if len(self.rows) > self.most_rows or self.chars > HELD_CHARS:
            self.leave()

    def leave(self) -> None:
        self.rows, self.at_edge = [], True

    def result(self) -> tuple:
        seen: set[tuple[str, str]] = set()
        features: list[Feature] = []
        for turn, role, text in self.rows:
            features += features_of(
                turn, role, 1, is_blank(text), (role, text) in seen, is_truncated(text)
            )
            seen.add((role, text))
        whole, value = repaired(features)
        digest = Digest()
        for role, text in replay(value[1], ((role, text) for _, role, text in self.rows)):
            digest.add(role, text)
        return _result(whole, value, digest.sha.hexdigest())


def _finish_whole(conv_type: pa.DataType, most_rows: int):
    """Results of conversations inside a range, and the ids, marked `at_edge`, of all others."""
    names = ["conv", "at_edge", *(part.split()[0] for part in RESULTS.split(", "))]
    kinds = [conv_type, pa.bool_(), *_KINDS]

    def finish(conv, held: _Held) -> tuple:
        rest = (None,) * len(_KINDS) if held.at_edge else held.result()
        return (conv, held.at_edge, *rest)

    def run(batches):
        held, current, done = None, None, []
        for conv, turn, role, text in _runs(batches, 4):
            if held is None or conv != current:
                if held is not None:
                    done.append(finish(current, held))
                    if len(done) >= 1000:
                        yield _as_batch(done, names, kinds)
                        done = []
                first = held is None
                held, current = _Held(most_rows), conv
                if first:
                    held.leave()
            held.add(turn, role, text)
        if held is not None:
            held.leave()
            done.append(finish(current, held))
        yield _as_batch(done, names, kinds)

    return run


def _derive_pieces(conv_type: pa.DataType):
    """Pieces of the conversations in a range, numbered in order, pickled in columns."""

    def run(batches):
        part, number, rows = TaskContext.get().partitionId(), 0, []
        features: list[Feature] = []
        pieces, current, begun = Pieces(), None, False

        def flush():
            nonlocal features
            if features:
                pieces.add(derive(features))
                features = []

        def ended():
            nonlocal number
            flush()
            number += 1
            return (current, part, number, _packed(pieces.joined()))

        for conv, turn, role, n, blank, seen, cut_short in _runs(batches, 7):
            if begun and conv != current:
                rows.append(ended())
                pieces = Pieces()
            current, begun = conv, True
            features += features_of(turn, role, n, blank, seen, cut_short)
            if len(features) >= PIECE_ROWS:
                flush()
        if begun:
            rows.append(ended())
        yield _as_batch(rows, ["conv", "part", "number", "piece"], [conv_type, pa.int64(), pa.int64(), _PIECE])

    return run


_VALUE = [("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_ENDS = [("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())]
_PIECE = pa.struct(
    [("values", pa.list_(pa.struct(_VALUE))), *((name, pa.int64()) for name in _COUNTS), *_ENDS]
)
PIECE = (
    "struct<values:array<struct<before:int,after:int,cost:bigint,audit:string>>,"
    "blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,"
    "first_role:string,last_role:string,first_turn:bigint,last_turn:bigint,turns:bigint>"
)


def _packed(piece: Piece) -> dict:
    values = [
        {"before": before, "after": after, "cost": cost, "audit": audit}
        for (before, after), (cost, audit) in piece.values.items()
    ]
    return {**vars(piece), "values": values}


def _unpacked(row: dict) -> Piece:
    values = {(v["before"], v["after"]): (v["cost"], v["audit"]) for v in row["values"]}
    return Piece(**{**row, "values": values})


def _join_pieces(conv_type: pa.DataType):
    """One row per conversation from its pieces in order."""
    names = ["conv", *(part.split()[0] for part in RESULTS.split(", "))]

    def run(batches):
        pieces, current, begun = Pieces(), None, False

        def ended():
            whole = pieces.joined()
            row = (current, *_result(whole, goal(whole), None))
            return _as_batch([row], names, [conv_type, *_KINDS])

        for conv, piece in _runs(batches, 2):
            if begun and conv != current:
                yield ended()
                pieces = Pieces()
            current, begun = conv, True
            pieces.add(_unpacked(piece))
        if begun:
            yield ended()

    return run


def _replayed(batches) -> Iterator[tuple[object, str, str]]:
    """Messages of conversations from rows `conv, audit, role, text`, the audit's row first."""

    def conversations():
        for conv, audit, role, text in _runs(batches, 4):
            yield conv, audit, role, text

    source, waiting = conversations(), None

    def rows_of():
        nonlocal waiting
        for row in source:
            if row[1] is not None:
                waiting = row
                return
            yield row[2], row[3]

    waiting = next(source, None)
    while waiting is not None:
        (conv, audit, _, _), waiting = waiting, None
        rest = rows_of()
        yield conv, None, None
        for role, text in replay(audit, rest):
            yield conv, role, text
        for _ in rest:  # up to the next audit
            pass


def _digests(conv_type: pa.DataType):
    def run(batches):
        digest, current, done = None, None, []
        for conv, role, text in _replayed(batches):
            if role is None:
                if digest is not None:
                    done.append((current, digest.sha.hexdigest()))
                digest, current = Digest(), conv
            else:
                digest.add(role, text)
        if digest is not None:
            done.append((current, digest.sha.hexdigest()))
        yield _as_batch(done, ["conv", "repaired_sha256"], [conv_type, pa.string()])

    return run


def _messages(conv_type: pa.DataType):
    names, kinds = ["conv", "place", "role", "text"], [conv_type, pa.int64(), pa.string(), pa.string()]

    def run(batches):
        place, rows = 0, []
        for conv, role, text in _replayed(batches):
            if role is None:
                place = 0
                continue
            place += 1
            rows.append((conv, place, role, text))
            if len(rows) >= 1000:
                yield _as_batch(rows, names, kinds)
                rows = []
        yield _as_batch(rows, names, kinds)

    return run


ORDER = ["conv", "turn", "role", "digest"]


def _read(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    def said(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    read = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        said(role).alias("role"),
        said(text).alias("text"),
    )
    return read.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))


def _arrow_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    kind = rows.schema["conv"].dataType.simpleString()
    known = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if kind not in known:
        raise ValueError(f"ids of type {kind} are not supported: {sorted(known)}")
    return kind, known[kind]


def _in_order_of_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """`conv, audit, role, text`: the rows of each audited conversation behind its audit."""
    nothing = F.lit(None)
    lead = audits.select(
        "conv", "audit", nothing.cast("string").alias("role"), nothing.cast("string").alias("text"),
        nothing.cast("bigint").alias("turn"), nothing.cast("string").alias("digest"),
    )
    body = rows.select("conv", nothing.cast("string").alias("audit"), "role", "text", "turn", "digest")
    together = lead.unionByName(body).withColumn("is_row", F.col("audit").isNull())
    dealt = together.repartition("conv").sortWithinPartitions("conv", "is_row", "turn", "role", "digest")
    return dealt.select("conv", "audit", "role", "text")


def _repair_cut(rows: DataFrame, kind: str, conv_type: pa.DataType) -> DataFrame:
    """Results of conversations of any length."""
    bare = F.translate("text", SPACE, "")
    features = rows.select(
        *ORDER,
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("cut_short"),
    )
    counted = features.groupBy(*ORDER, "blank", "cut_short").agg(F.count(F.lit(1)).alias("n"))
    told = ["conv", "role", "digest"]
    # NULL turns come first, so the struct's flag is compared before the turn.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = features.groupBy(*told).agg(F.min(place).alias("first")).toDF(*(f"{c}_2" for c in told), "first")
    same = [counted[name].eqNullSafe(first[f"{name}_2"]) for name in told]
    marked = counted.join(first, same[0] & same[1] & same[2]).withColumn("seen", place != F.col("first"))
    ranged = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    pieces = ranged.select("conv", "turn", "role", "n", "blank", "seen", "cut_short").mapInArrow(
        _derive_pieces(conv_type), f"conv {kind}, part bigint, number bigint, piece {PIECE}"
    )
    dealt = cut_lineage(pieces).repartition("conv").sortWithinPartitions("conv", "part", "number")
    results = cut_lineage(
        dealt.select("conv", "piece").mapInArrow(_join_pieces(conv_type), f"conv {kind}, {RESULTS}")
    ).drop("repaired_sha256")
    digests = _in_order_of_audits(rows, results).mapInArrow(
        _digests(conv_type), f"conv_2 {kind}, repaired_sha256 string"
    )
    return results.join(digests, F.col("conv").eqNullSafe(F.col("conv_2"))).drop("conv_2")


def repair_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """One row for each conversation with rows: its faults, and the cheapest repair.

    `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`, where the
    first has the name given. A task holds at most `held_rows` rows of a conversation at once.
    """
    prepare_workers(rows.sparkSession)
    read = _read(rows, conv, turn, role, text)
    kind, conv_type = _arrow_type(read)
    # Equal rows are told apart by their place, so that any number of them can be dealt out.
    ranged = read.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*ORDER, "place")
    finished = cut_lineage(
        ranged.sortWithinPartitions(*ORDER)
        .select("conv", "turn", "role", "text")
        .mapInArrow(_finish_whole(conv_type, held_rows), f"conv {kind}, at_edge boolean, {RESULTS}")
    )
    whole = finished.filter("NOT at_edge").drop("at_edge")
    edges = finished.filter("at_edge").select(F.col("conv").alias("edge")).distinct()
    cut = read.join(edges, F.col("conv").eqNullSafe(F.col("edge")), "left_semi")
    results = whole.unionByName(_repair_cut(cut, kind, conv_type))
    return results.withColumnRenamed("conv", conv)


def repaired_messages(
    rows: DataFrame,
    repairs: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The messages of the repaired conversations: `conv_id, place, role, text`.

    `repairs` is what `repair_conversations` returned for the same rows.
    """
    prepare_workers(rows.sparkSession)
    read = _read(rows, conv, turn, role, text)
    kind, conv_type = _arrow_type(read)
    audits = repairs.select(F.col(f"`{conv}`").alias("conv"), "audit")
    messages = _in_order_of_audits(read, audits).mapInArrow(
        _messages(conv_type), f"conv {kind}, place bigint, role string, text string"
    )
    return messages.withColumnRenamed("conv", conv)
