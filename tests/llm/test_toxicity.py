import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tripgrain.llm.queries import op10_toxicity
from tripgrain.llm.toxicity import DECAY, GAPS, LETTERS, Landmarks, fit_machine, fit_toxicity, score_documents, subsequences, units

INSULTS = ["blorkhead", "snivelwit", "gromp"]


def sentences(count, seed):
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice(["ta", "ri", "no", "el", "su"]) for _ in range(chance.randrange(1, 4)))
    rows = []
    for at in range(count):
        words, toxic = [word() for _ in range(chance.randrange(3, 25))], int(chance.random() < 0.3)
        if toxic:
            words.insert(chance.randrange(len(words)), chance.choice(INSULTS))
        rows.append((at, " ".join(words), toxic))
    return rows


def test_subsequences_against_all_choices():
    word = "abracadabra"
    expected = Counter()
    for places in combinations(range(len(word)), LETTERS):
        span = places[-1] - places[0] + 1
        if span <= LETTERS + GAPS:
            expected[tuple(word[p] for p in places)] += DECAY ** (span - LETTERS)
    found = subsequences(word)
    assert found.keys() == expected.keys()
    assert all(abs(found[key] - value) < 1e-12 for key, value in expected.items())


def test_whitened_landmarks_reproduce_their_kernel():
    landmarks = Landmarks(["idiot", "clown", "clowns", "trash"])
    gram = np.array([landmarks.kernels(string) for string in landmarks.strings])
    embedded = gram @ landmarks.whitening
    assert np.allclose(embedded @ embedded.T, gram, atol=1e-6)


def test_words_put_apart_are_read_together():
    assert "idiot" in units("you i.d.i.o.t") and "idiot" in units("you i d i o t now") and units("a b") == set()
    assert all(len(unit) <= 64 for unit in units("x" * 1000)) and units("") == set()


@pytest.fixture(scope="module")
def model():
    rows = sentences(600, 1)
    return fit_machine([sorted(units(text)) for _, text, _ in rows], [toxic for *_, toxic in rows])


def score(model, text):
    return model.probability(model.base + max([0.0, *map(model.margin_of_word, units(text))]))


def test_held_out_sentences_and_disguises(model):
    right = [(score(model, text) >= 0.5) == bool(toxic) for _, text, toxic in sentences(300, 2)]
    assert sum(right) / len(right) > 0.98
    for text in ("blork-head", "s n i v e l w i t", "snivvelwit", "blorkxhead", "GROMP!"):
        assert score(model, f"tari nosu {text} elsu") >= 0.5, text
    assert score(model, "") < 0.5 and score(model, "tari nosu elsu") < 0.5


def test_rows_of_all_kinds(spark):
    rows = [*sentences(200, 3), (900, None, None), (901, "", 0), (902, "gromp " * 50_000, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, SCORE string")
    labels = spark.createDataFrame([(i, y) for i, _, y in [*rows, rows[0], (None, "", 1)]], "doc_id bigint, toxic int")
    df = df.unionByName(df.filter("doc_id = 7"))
    scored = score_documents(df, fit_toxicity(df, labels))
    assert scored.columns == ["doc_id", "text", "score"]
    found = scored.collect()
    assert len(found) == len(rows) + 1 and all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert by_id[902] >= 0.5 > by_id[901] == by_id[900]


def test_one_class_or_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    for labels, low in (([], True), ([(1, 0)], True), ([(1, 1)], False)):
        frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        found = score_documents(df, fit_toxicity(df, frame)).collect()
        assert all((r["score"] < 0.5) == low for r in found)
    assert score_documents(df.limit(0), fit_toxicity(df, frame)).collect() == []


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in op10_toxicity(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(found) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [(found[r["doc_id"]], r["toxic"]) for r in labels if found[r["doc_id"]]["held_out"]]
    right = [
        row["predicted"] == toxic for row, toxic in held]
    assert sum(right) / len(right) > 0.95


def test_short_insults_and_more_than_48_are_found():
    chance = random.Random(4)
    plain = [text for _, text, toxic in sentences(2500, 3) if not toxic]
    letters = "bcdfghjkmpqvwxz"
    insults = list({"".join(chance.choice(letters) for _ in range(7)) for _ in range(60)})
    short = ["zug", "qip"]
    rows = [(text, 0) for text in plain]
    for insult in [*insults, *short]:
        rows += [(f"{chance.choice(plain)} {insult}", 1) for _ in range(6)]
    model = fit_machine([sorted(units(text)) for text, _ in rows], [toxic for _, toxic in rows])
    plain_scores = [score(model, text) for text, toxic in rows if not toxic]
    assert sum(value >= 0.5 for value in plain_scores) <= 0.02 * len(plain_scores)
    for insult in [*insults, *short, "z u g", "q.i.p"]:
        assert score(model, f"tari elno {insult} su") >= 0.5, insult


def test_words_of_toxic_documents_stand_in_for_missing_landmarks():
    model = fit_machine([["\x02zug\x02"], ["tari"], ["elno"]], [1, 0, 0])
    assert score(model, "zug") > score(model, "tari")
    none = fit_machine([[], ["tari"], ["elno"], ["suri"]], [1, 0, 0, 0])
    assert abs(score(none, "anything") - 0.25) < 1e-9 and abs(score(none, "") - 0.25) < 1e-9
