"""Weak supervision: counts against brute force, the label model on votes with known accuracies, held-out texts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from brute import plain
from pyspark.sql import functions as F

from fleetlens.llm import toxicity as tox

SCHEMA = "doc_id long, text string, lang string, label string, key string, votes string"


def corpus(n=600, seed=4):
    """Every sixth text is toxic and holds two words of one of two vocabularies; half of the texts have labels."""
    rng = np.random.default_rng(seed)
    kinds = [["nasty", "vermin", "filthy", "rotten"], ["schmutzig", "widerlich", "dreckig", "erbaermlich"]]
    rows, labels = [], []
    for i in range(n):
        words = [f"w{k}" for k in rng.integers(0, 400, rng.integers(5, 40))]
        if i % 6 == 0:
            for w in rng.choice(kinds[i % 12 == 0], 2):
                words.insert(int(rng.integers(0, len(words))), str(w) + ("" if i % 12 else "e"))
        rows.append((i, " ".join(words), "xx", "a", "b", "c"))
        if i % 2 == 0:
            labels.append((i, int(i % 6 == 0)))
    return rows, labels


def test_term_counts_equal_brute_force(spark):
    rows, labels = corpus(120)
    texts = {r[0]: r[1] for r in rows}
    labelled = [(texts[i], float(y), 1.0 + i % 3) for i, y in labels] + [("Ärger ÄRGER", 1.0, 2.0), (None, 0.0, 1.0), ("", 1.0, 1.0)]
    got = tox._term_counts(spark.createDataFrame(labelled, "text string, toxic double, weight double").repartition(3))

    support, want = Counter(), Counter()
    for text, y, w in labelled:
        found = Counter(t for word in plain(text) for t in tox.word_terms(word.encode()))
        if y >= 0.5:
            support.update(found.keys())
        for t, n in found.items():
            for level in range(1, min(n, tox.LEVELS) + 1):
                want[t, level, y >= 0.5] += w
    kept = {t for t, n in support.items() if n >= tox.MIN_SUPPORT}
    expected = {(t, level): (want[t, level, True], want[t, level, False]) for t, level, _ in want if t in kept}
    assert {(bytes(r.term), r.level): (r.pos, r.neg) for r in got.collect()} == expected


def test_label_model_finds_accuracies_and_groups(spark):
    """Five voters fire apart from each other given the label; three more repeat the first one."""
    rng = np.random.default_rng(3)
    n, fire = 20_000, np.array([[0.01, 0.02, 0.05, 0.01, 0.3], [0.5, 0.4, 0.6, 0.3, 0.3]])
    y = (rng.random(n) < 0.2).astype(int)
    votes = rng.random((n, 5)) < fire[y]
    votes = np.concatenate([votes, np.repeat(votes[:, :1], 3, axis=1)], axis=1)
    known = np.where(rng.random(n) < 0.05, y, -1)
    packed = np.packbits(votes, axis=1)
    counts = Counter((packed[i].tobytes(), None if known[i] < 0 else int(known[i])) for i in range(n))
    frame = spark.createDataFrame([(v, k, c) for (v, k), c in counts.items()], "votes binary, label int, n long").repartition(4)
    model = tox.label_model(frame, 8)
    assert [0, 5, 6, 7] in model.groups and len(model.groups) == 5
    assert abs(1 - model.priors[0] - 0.2) < 0.05
    got = model.posterior(votes)
    assert ((got > 0.5) == (y == 1)).mean() > 0.9
    useless = next(g for g, members in enumerate(model.groups) if members == [4])
    toxic = model.priors[1:] / model.priors[1:].sum()
    assert abs(toxic @ model.levels[useless][1:, 1] - model.levels[useless][0, 1]) < 0.1
    first = next(g for g, members in enumerate(model.groups) if members[0] == 0)
    assert model.levels[first][0, 0] > 0.95 and abs(toxic @ model.levels[first][1:, 0] - 0.5) < 0.1


def test_voters_of_one_kind_do_not_speak_against_another(spark):
    """Two kinds of toxic texts, each with three voters that are silent on the other."""
    rng = np.random.default_rng(5)
    n = 9_000
    kind = rng.choice(3, n, p=[0.85, 0.12, 0.03])
    fire = np.array([[0.005] * 6, [0.6] * 3 + [0.005] * 3, [0.005] * 3 + [0.5] * 3])
    votes = rng.random((n, 6)) < fire[kind]
    known = np.where(rng.random(n) < 0.3, kind > 0, -1)
    packed = np.packbits(votes, axis=1)
    counts = Counter((packed[i].tobytes(), None if known[i] < 0 else int(known[i])) for i in range(n))
    frame = spark.createDataFrame([(v, k, c) for (v, k), c in counts.items()], "votes binary, label int, n long")
    model = tox.label_model(frame, 6)
    some = votes.sum(axis=1) > 1
    assert (model.posterior(votes)[(kind == 2) & some] > 0.5).mean() > 0.95
    assert (model.posterior(votes)[kind == 0] < 0.5).mean() > 0.97
    assert abs(1 - model.priors[0] - 0.15) < 0.03


def test_logistic_weights_do_not_fall_below_zero():
    rows = [np.array([0, 1]), np.array([0]), np.array([1]), np.array([], np.int64)] * 50
    y = np.array([1.0, 1.0, 0.0, 0.0] * 50)
    values, base = tox.logistic(rows, y, np.ones(len(y)), 2)
    assert values[0] > 2 and 0 <= values[1] < 0.5 and base < 0


def test_held_out_texts_and_determinism(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, toxic long")
    train, held = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    model = tox.train(train, marks.where("doc_id % 5 <> 0"))
    scores = {r.doc_id: r.score for r in tox.score(held, model).collect()}
    right = [(scores[i] >= 0.3) == (i % 6 == 0) for i in scores]
    assert len(right) == 120 and np.mean(right) > 0.95
    again = tox.train(train.repartition(7), marks.where("doc_id % 5 <> 0").repartition(3))
    assert again.features == model.features
    assert np.allclose([again.score_text(r[1]) for r in rows[:50]], [model.score_text(r[1]) for r in rows[:50]], atol=1e-6)


def test_edge_rows(spark):
    rows, labels = corpus()
    odd = [
        (1000, None, "x", "", "", ""), (1001, "", "x", "", "", ""), (1002, "nasty vermin " * 20_000, "x", "", "", ""),
        (None, "nasty filthy", "x", "", "", ""), (0, "w1 w2", "x", "", "", ""), (0, "w1 w2", "x", "", "", ""),
    ]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    marks = spark.createDataFrame([*labels, (0, 0), (0, None), (None, 1), (1001, None)], "doc_id long, toxic long")
    model = tox.train(docs, marks)
    got = tox.score(docs, model)
    assert got.count() == len(rows) + len(odd)
    by_id = {r.doc_id: r.score for r in got.collect()}
    assert by_id[1000] == by_id[1001] < 0.3 <= min(by_id[1002], by_id[None])
    assert got.where("not score between 0 and 1").isEmpty()
    empty = docs.limit(0)
    assert tox.score(empty, model).collect() == []
    nothing = tox.train(empty, marks.limit(0))
    assert nothing.score_text("nasty") == nothing.score_text(None) < 0.01
    one_kind = tox.train(docs, marks.where("toxic = 0"))
    assert one_kind.score_text("nasty") < 0.3


@pytest.mark.parametrize("text", ["STOP THAT NOW you", "sh**t", "noooooo", "what?!!"])
def test_patterns_fire(text):
    assert any(p.search(text) for p in tox.PATTERNS.values())


def test_registered_query_on_tables(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op13_toxicity"](spark, sf)
    assert [f.simpleString() for f in got.schema] == [
        "doc_id:bigint", "held_out:boolean", "score:double", "predicted:int",
    ]
    marks = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    english = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id")
    rows = got.join(marks, "doc_id").join(english, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    assert np.mean(toxic) > 0.6 and not any(r.predicted for r in rows if not r.toxic)
