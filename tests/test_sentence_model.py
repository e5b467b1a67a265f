"""The trained sentence classifier: held-out accuracy, plain scores, odd rows, saving."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagtide.functions import sentiment
from tagtide.operators import sentence_model as M
from tagtide.plans import registry

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "sentence string, label int"


def sentences(n, seed):
    """Up to three words of the list among others, and their class."""
    pick = random.Random(seed)
    good, bad, other = sentiment.POSITIVE[:12], sentiment.NEGATIVE[:12], [f"word{i}" for i in range(60)]
    rows = []
    for _ in range(n):
        felt = [pick.choice(pick.choice([good, bad])) for _ in range(pick.randrange(4))]
        text = felt + [pick.choice(other) for _ in range(pick.randrange(8))]
        pick.shuffle(text)
        balance = sum(1 if w in good else -1 for w in felt)
        rows.append((" ".join(text).capitalize() + "!", min(4, max(0, 2 + balance))))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return M.train(spark.createDataFrame(sentences(4000, 1), SCHEMA).repartition(5))


def test_held_out_accuracy(model):
    rows = sentences(2000, 2)
    said = model.classify([s for s, _ in rows])
    assert np.mean([a == b for a, (_, b) in zip(said, rows, strict=True)]) > 0.95


def test_classes_are_those_of_plain_scores(model):
    """A dense matrix of word counts times the weights."""
    rows = [s for s, _ in sentences(300, 3)] + ["", "unknown words only", "GOOD_x good! Good"]
    order = sorted(model.weights)
    counts = np.array([[M.WORD.findall(s.lower()).count(w) for w in order] for s in rows])
    plain = counts @ np.array([model.weights[w] for w in order]) + model.bias
    assert model.classify(rows) == plain.argmax(axis=1).tolist()


def test_words_are_looked_up_and_summed_at_once(model):
    """The same classes as by adding word after word, in less than half the time."""
    pick = random.Random(5)
    pool = [*model.weights, "unknown", "É", "x.y", "Kelvin\u212a", "\u0130st", "\ud800"]
    rows = [" ".join(pick.choices(pool, k=3000)).title() for _ in range(60)]
    none, started = np.zeros(M.CLASSES), time.process_time()
    plain = [int((model.bias + sum((model.weights.get(w, none) for w in M.WORD.findall(s.lower())), none)).argmax()) for s in rows]
    halfway = time.process_time()
    assert model.classify(rows) == plain
    assert time.process_time() - halfway < (halfway - started) / 2


def test_near_the_solution_of_plain_gradient_descent(spark):
    """The same loss, minimised in one array; L1 alone tells them apart."""
    rows = sentences(600, 4)
    model = M.train(spark.createDataFrame(rows, SCHEMA).repartition(3))
    order = sorted({w for s, _ in rows for w in M.WORD.findall(s.lower())})
    x = np.array([[M.WORD.findall(s.lower()).count(w) for w in order] for s, _ in rows], float)
    y = np.eye(M.CLASSES)[[c for _, c in rows]]
    weight = (1 / y.sum(axis=0))[y.argmax(axis=1)][:, None] / M.CLASSES
    w, b = np.zeros((len(order), M.CLASSES)), np.zeros(M.CLASSES)

    def odds(w, b):
        z = np.exp((z := x @ w + b) - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    for _ in range(4000):
        error = (odds(w, b) - y) * weight
        w, b = w - 2.0 * x.T @ error, b - 2.0 * error.sum(axis=0)
    ours = np.array([model.weights.get(word, np.zeros(M.CLASSES)) for word in order])
    loss = [-(weight * y * np.log(odds(*p) + 1e-12)).sum() for p in ((ours, model.bias), (w, b))]
    assert loss[0] < loss[1] + 0.05
    assert np.mean(odds(ours, model.bias).argmax(axis=1) == odds(w, b).argmax(axis=1)) > 0.95


def test_saved_and_loaded(spark, model, tmp_path):
    model.save(spark, f"{tmp_path}/model")
    loaded = M.SentenceModel.load(spark, f"{tmp_path}/model")
    assert loaded.weights.keys() == model.weights.keys() and (loaded.bias == model.bias).all()
    texts = [(s,) for s, _ in sentences(50, 5)] + [(None,), ("",), ("Good. Bad! Word1 great good",)]
    df = spark.createDataFrame(texts, "t string")
    rows = df.select("t", M.scorer(spark, loaded)(F.col("t")).alias("s")).collect()
    for row in rows:
        found = model.classify([p for p in (row.t or "").replace("!", ".").split(".") if p.strip()])
        assert row.s == (sum(found) // len(found) if found else sentiment.NEUTRAL)


@pytest.mark.parametrize(
    ("rows", "said"),
    [
        ([], 2),
        ([(None, 4), ("good", None), ("good", 7), ("bad", -1)], 2),
        ([("good day", 3), ("good day", 3), ("a day", 3)], 3),
        ([("one", 4), ("two", 1), ("three", 1)], 1),  # no word in two rows
    ],
)
def test_odd_tables(spark, rows, said):
    model = M.train(spark.createDataFrame(rows, SCHEMA))
    assert model.classify(["good", "", "any other"]) == [said] * 3


def test_classes_without_examples_are_never_said(spark):
    rows = [(f"{w} day {i % 7}", c) for i in range(40) for w, c in (("good", 3), ("bad", 1))]
    model = M.train(spark.createDataFrame(rows, SCHEMA))
    assert model.classify(["good", "bad", "good day 3"]) == [3, 1, 3]
    assert set(model.classify(["nothing", ""])) <= {1, 3}


def test_repeated_rows_count_and_clashing_columns_are_not_read(spark):
    rows = [("good x", 3, "a", 1), ("good x", 1, "b", 2)] + [("good x", 3, "c", 3)] * 5 + [("bad y", 1, "d", 4)] * 5 + [("bad z", 1, "", 0), ("good z", 3, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA + ", words string, n int")
    found = {(tuple(r.words), r.label): r.n for r in M.training_rows(df, "sentence", "label").collect()}
    assert found[("good", "x"), 3] == 6 and found[("good", "x"), 1] == 1
    assert M.train(df).classify(["good x", "bad y"]) == [3, 1]


def test_query_on_held_out_posts(spark):
    rows = registry.sentiment_trained(spark, SF_DIR).collect()
    assert len(rows) == registry.dedup_latest(spark, SF_DIR).count()
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.sentiment == r.lexicon for r in held]) > 0.95
