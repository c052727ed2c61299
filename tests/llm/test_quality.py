import random

import numpy as np

from tripgrain.llm.quality import features, fit_ordinal, fit_quality, good_documents, grade_documents
from tripgrain.llm.queries import op7_quality


def rated(count, seed):
    chance = random.Random(seed)
    rows = []
    for at in range(count):
        grade = chance.randrange(3)
        words = [("good" if chance.random() < grade / 2 else "bad") + str(chance.randrange(4)) for _ in range(60)]
        rows.append((at, " ".join(words), float(grade)))
    return rows


def test_three_grades_in_order():
    train, test = rated(400, 1), rated(200, 2)
    model = fit_ordinal([features(text) for _, text, _ in train], [grade for *_, grade in train])
    assert model.grades == [0.0, 1.0, 2.0] and model.thresholds[0] < model.thresholds[1]
    scores = np.array([model.score(text) for _, text, _ in test])
    tails = model.tails(scores)
    assert (tails[:, 0] >= tails[:, 1]).all()
    guess = tails.sum(axis=1).round()
    assert (guess == np.array([grade for *_, grade in test])).mean() > 0.9


def test_gradient_is_that_of_the_likelihood():
    """More steps of training never end at a lower likelihood than the start."""
    rows = rated(200, 3)
    vectors = [features(text) for _, text, _ in rows]
    model = fit_ordinal(vectors, [grade for *_, grade in rows])
    scores = np.array([float(model.weights[i] @ v) for i, v in vectors])
    chances = np.concatenate([np.ones((200, 1)), model.tails(scores), np.zeros((200, 1))], axis=1)
    grades = np.array([int(grade) for *_, grade in rows])
    likelihood = np.log(chances[np.arange(200), grades] - chances[np.arange(200), grades + 1]).mean()
    assert likelihood > np.log(1 / 3) / 2


def test_nulls_ties_and_empty_texts(spark):
    rows = [*rated(120, 4), (900, None, None), (901, "", 2.0), (902, "", 0.0), (903, "bad0 " * 50_000, None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in [*rows, rows[0], (None, "", 1.0)]], "doc_id bigint, quality double")
    df = df.unionByName(df.filter("doc_id = 5")).selectExpr("*", "'x' as EXPECTED_grade")
    model = fit_quality(df, ratings)
    graded = grade_documents(df, model)
    assert graded.columns == ["doc_id", "text", "expected_grade", "top_probability"]
    found = graded.collect()
    assert len(found) == len(rows) + 1
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["top_probability"] <= 1 for r in found)
    kept = good_documents(df, ratings)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in found if r["top_probability"] >= 0.5)


def test_without_ratings_nothing_is_rejected(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert good_documents(df, none).count() == good_documents(df, one).count() == 2
    assert {r["expected_grade"] for r in grade_documents(df, fit_quality(df, none)).collect()} == {None}
    assert {r["expected_grade"] for r in grade_documents(df, fit_quality(df, one)).collect()} == {1.0}
    assert grade_documents(df.limit(0), fit_quality(df, one)).collect() == []


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(df, labels.filter("doc_id % 4 <> 0"))
    held = labels.filter("doc_id % 4 = 0")
    found = grade_documents(df, model).join(held, "doc_id").collect()
    right = [(r["top_probability"] >= 0.5) == (r["quality"] == 1) for r in found]
    assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_query_covers_all_rows(spark, sf_dir):
    total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert op7_quality(spark, sf_dir).count() == total


def test_words_are_read_behind_character_64():
    head = "漢" * 64
    for one, other in ((head + "字" * 500, head + "語" * 500), (head + "x" * 300_000, head + "9x" * 150_000), ("y" * 64 + "a", "y" * 64 + "b")):
        (i, v), (j, w) = features(one), features(other)
        assert dict(zip(i.tolist(), v.tolist())) != dict(zip(j.tolist(), w.tolist()))
    chance = random.Random(7)
    texts = [(head + ("好" if grade else "壞") * 64 * chance.randrange(3, 9), float(grade)) for grade in (0, 1) * 60]
    model = fit_ordinal([features(text) for text, _ in texts], [grade for _, grade in texts])
    scores = model.tails(np.array([model.score(text) for text, _ in texts]))[:, 0]
    assert all((score >= 0.5) == (grade == 1) for score, (_, grade) in zip(scores, texts))


def test_pieces_of_a_long_word_count_as_words():
    whole, apart = features("p" * 64 + "q" * 64 + "rs t"), features("p" * 64 + " " + "q" * 64 + " rs t")
    assert whole[0].tolist() == apart[0].tolist() and whole[1].tolist() == apart[1].tolist()
