import hashlib
import itertools
import random
import re

import pytest
from tripgrain.llm import conversations as c

KIND = "conv_id bigint, turn bigint, role string, text string"
ROLES = {"user": "u", "assistant": "a"}
FORM = re.compile(r"(s?(ua)+)?\Z")


def in_order(rows):
    """Rows `turn, role, text` of one conversation, NULLs read as a space."""
    read = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(read, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def every_repair(rows):
    """The least (cost, audit, repaired) over all sequences of edits with up to three inserts."""
    fault, best = faults(rows), None
    for inserts in range(4):
        for letters in itertools.product("KRD", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(fault, letters)):
                continue
            for gaps in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                free, out, audit, cost = [], [], "", 0
                for at in range(len(rows) + 1):
                    for _ in range(gaps.count(at)):
                        audit, cost = audit + "I", cost + 5
                        out.append((None, ""))
                    if at < len(rows):
                        e = letters[at]
                        audit += e
                        cost += {"K": 0, "R": 1, "D": 2}[e] + (5 if e != "D" and fault[at] == "truncated" else 0)
                        if e != "D":
                            out.append((rows[at][1] if e == "K" else None, rows[at][2]))
                free = [i for i, (role, _) in enumerate(out) if role is None]
                for roles in itertools.product(ROLES, repeat=len(free)):
                    said = list(out)
                    for i, role in zip(free, roles):
                        said[i] = (role, said[i][1])
                    if FORM.match("".join(role[:1] or "-" for role, _ in said)):
                        if best is None or (cost, audit) < best[:2]:
                            best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in said))
    return best


def by_states(rows):
    """The same for long conversations: lightest values row by row."""
    states = {"": (0, "")}
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    free = {"": "u", "s": "u", "a": "u", "u": "a"}

    def with_inserts(states):
        for _ in range(3):
            for at, (cost, audit) in list(states.items()):
                value = (cost + 5, audit + "I")
                if states.get(free[at], (1 << 60, "")) > value:
                    states[free[at]] = value
        return states

    states = with_inserts(states)
    for (_, role, _), fault in zip(rows, faults(rows)):
        new, more = {}, 5 if fault == "truncated" else 0
        for at, (cost, audit) in states.items():
            ways = [(at, cost + 2, audit + "D")]
            if fault not in ("blank", "duplicate"):
                ways.append((free[at], cost + 1 + more, audit + "R"))
                if (at, role[:1]) in step:
                    ways.append((step[at, role[:1]], cost + more, audit + "K"))
            for after, total, letters in ways:
                if new.get(after, (1 << 60, "")) > (total, letters):
                    new[after] = (total, letters)
        states = with_inserts(new)
    return min(states[at] for at in ("", "a") if at in states)


def counts(rows):
    turns = [t for t, _, _ in rows if t is not None]
    found = faults(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
    )


def grouped(rows):
    by_conv = {}
    for conv, *rest in rows:
        by_conv.setdefault(conv, []).append(tuple(rest))
    return {conv: in_order(some) for conv, some in by_conv.items()}


def random_rows(seed, convs, most):
    pick = random.Random(seed)
    texts = ["Ja.", "no", "  ", None, "Why?\n", "a ", "x.", "x."]
    return [
        (conv if conv % 9 else None, pick.choice([None, 0, 1, 2, 5, 9]), pick.choice(["user", "assistant", "system", None, "", "tool"]), pick.choice(texts))
        for conv in range(convs)
        for _ in range(pick.randint(1, most))
    ]


def test_every_edit_sequence(spark):
    rows = [r for r in random_rows(3, 160, 4) if r[0] is not None]
    found = {r[0]: tuple(r)[1:] for r in c.repair_conversations(spark.createDataFrame(rows, KIND)).collect()}
    expected = {}
    for conv, some in grouped(rows).items():
        cost, audit, said = every_repair(some)
        expected[conv] = (*counts(some), cost, audit, hashlib.sha256(said.encode()).hexdigest())
    assert found == expected


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_long_conversations_are_cut_anywhere(spark, partitions):
    """One conversation holds most rows; the NULL one and equal rows are many, too."""
    pick = random.Random(11)
    rows = random_rows(5, 60, 6)
    rows += [(7, pick.randint(0, 400), pick.choice(["user", "assistant", "user", "system"]), f"{pick.choice('abc')} {pick.randint(0, 90)}{pick.choice(['.', '', '!'])}") for _ in range(1500)]
    rows += [(None, 4, "assistant", "same.")] * 300
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(rows, KIND).repartition(7)
        repairs = c.repair_conversations(frame)
        found = {r[0]: tuple(r)[1:] for r in repairs.collect()}
        messages = {}
        for row in c.repaired_messages(frame, repairs).orderBy("place").collect():
            messages.setdefault(row["conv_id"], []).append(f"{row['role']}:{row['text']}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for conv, some in grouped(rows).items():
        assert found[conv][:5] == counts(some)
        assert found[conv][5:7] == by_states(some)
        said = "\n".join(messages.get(conv, []))
        assert found[conv][7] == hashlib.sha256(said.encode()).hexdigest()
        assert FORM.match("".join(m[0] for m in messages.get(conv, [])))
    assert found.keys() == grouped(rows).keys()


def test_short_limits_give_the_same(spark):
    """Conversations that a task gives up are repaired as tables, with equal results."""
    rows = random_rows(8, 80, 9)
    frame = spark.createDataFrame(rows, KIND)
    usual = sorted(map(repr, c.repair_conversations(frame).collect()))
    for held_rows in (0, 3):
        assert sorted(map(repr, c.repair_conversations(frame, held_rows=held_rows).collect())) == usual


def test_pieces_join_anywhere():
    pick = random.Random(4)
    for size in (1, 5, 30):
        features = [(t, pick.choice("sua-"), pick.choice([0, 0, 1, 2]), 1, 0, 0, 0) for t in range(size)]
        features = [(t, i, f, n, int(f == 2), 0, int(f == 1)) for t, i, f, n, *_ in features]
        whole, value = c.repaired(features)
        for width in (1, 2, 7):
            pieces = c.Pieces()
            for at in range(0, size, width):
                pieces.add(c.derive(features[at : at + width]))
            joined = pieces.joined()
            assert c.goal(joined) == value
            assert {**vars(joined), "values": 0} == {**vars(whole), "values": 0}


def test_odd_tables(spark):
    assert c.repair_conversations(spark.createDataFrame([], KIND)).collect() == []
    long = "word " * 200_000 + "."
    frame = spark.createDataFrame(
        [("x", 1, "user", long, 5), ("x", 2, "assistant", "", 6), (None, None, None, None, 7)],
        "conv_id string, turn bigint, role string, text string, cost int",
    )
    found = {r["conv_id"]: r for r in c.repair_conversations(frame).collect()}
    assert found["x"]["audit"] == "DD" and found["x"]["cost"] == 4 and found["x"]["blank"] == 1
    assert found[None]["audit"] == "D" and found[None]["gaps"] == 0


def test_values_only_grow():
    """A derived item is greater than the item it comes from."""
    for state in c.STATES:
        for step in [(i, f, n) for i in "sua-" for f in (c.FINE, c.CUT_SHORT, c.MUST_GO) for n in (1, 3)]:
            for _, cost, letters in c._edits(state, step):
                assert (4 + cost, "KD" + letters) > (4, "KD")
