"""Quality and toxicity: held-out accuracy, brute-force parts, awkward rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from tessera.llm import quality, toxicity
from tessera.llm.common import read_table
from tessera.llm.quality import document_stats, fit_quality, keep_quality, op8_quality, pool_adjacent, score_stats
from tessera.llm.toxicity import fit_chain, fit_logistic, fit_toxicity, op2_toxicity, score_toxicity, words_of

from .helpers import ROWS, awkward, empty

MEDIUM = "/root/testdata/sf0.01"


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        y, w = rng.random(7), rng.integers(1, 4, 7).astype(float)
        at, to = pool_adjacent(np.arange(7.0), y, w)
        assert (np.diff(to) > 0).all() and (np.diff(at) > 0).all()
        best = np.inf
        for cuts in itertools.product((0, 1), repeat=6):  # every way to pool neighbours
            block = np.concatenate([[0], np.cumsum(cuts)])
            fit = np.array([np.average(y[block == b], weights=w[block == b]) for b in block])
            if (np.diff(fit) >= -1e-12).all():
                best = min(best, (w * (y - fit) ** 2).sum())
        value = np.array([to[np.searchsorted(at, x - 1e-9)] if x <= at[-1] else to[-1] for x in range(7)])
        sizes = [np.sum(w * (y - v) ** 2) for v in (value,)]
        pooled = {round(v, 9) for v in to}
        assert len(pooled) == len(to) and sizes[0] >= best - 1e-9


def test_normal_equations_are_whole_sums(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATS)
    data = [(rng.normal(size=d).tolist(), float(k % 2)) for k in range(300)]
    model = quality.QualityModel(np.zeros(d), np.ones(d), np.zeros(0), np.zeros(1), np.zeros(1))
    a, b = quality._normal_equations(spark.createDataFrame(data, "stats array<double>, y double").repartition(5), model)
    x = model.features(np.array([s for s, _ in data]))
    assert np.allclose(a, x.T @ x) and np.allclose(b, x.T @ np.array([y for _, y in data]))


def test_fourier_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(quality, "COSINES", 20_000)
    d = len(quality.STATS)
    model = quality.QualityModel(np.zeros(d), np.ones(d), np.zeros(0), np.zeros(1), np.zeros(1))
    x = np.random.default_rng(2).normal(size=(6, d))
    phi = model.features(x)[:, 1 + d:]
    gram = phi @ phi.T / 20_000
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(gram - want).max() < 0.05


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    for v in np.unique(score):
        rank[score == v] = np.searchsorted(score[order], [v, v], side="left")[0] + (np.sum(score == v) + 1) / 2
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_quality_on_held_out_rows(spark):
    out = op8_quality(spark, MEDIUM).toPandas()
    assert list(out.columns) == ["doc_id", "held_out", "score", "predicted"]
    docs = read_table(spark, MEDIUM, "documents").select("doc_id").toPandas()
    assert sorted(out["doc_id"]) == sorted(docs["doc_id"])
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out["doc_id"]]).all()
    assert out["score"].between(0, 1).all() and (out["predicted"] == (out["score"] >= 0.5)).all()
    both = out[out["held_out"]].merge(read_table(spark, MEDIUM, "labels").toPandas(), on="doc_id")
    assert len(both) > 100
    assert (both["predicted"] == both["quality"]).mean() > 0.9
    assert auc(both["score"].to_numpy(), both["quality"].to_numpy()) > 0.8


def test_quality_rows(spark):
    stats = document_stats(awkward(spark))
    labels = spark.createDataFrame(
        [(k, k % 2, "c") for k in (1, 3, 5, 6, 7, 8)] + [(5, 1, "c"), (6, None, "c"), (None, 1, "c"), (99, 0, "c")],
        "doc_id long, quality int, y string")
    model = fit_quality(stats, labels)
    out = score_stats(stats, model).collect()
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(map(str, (r[0] for r in ROWS)))
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3, 4)}) == 1
    kept = keep_quality(awkward(spark), model)
    assert kept.schema == awkward(spark).schema
    assert kept.count() == sum(r["predicted"] for r in out)


def test_quality_without_evidence(spark):
    stats = document_stats(awkward(spark))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in score_stats(stats, fit_quality(stats, none)).collect()} == {1.0}
    nothing = document_stats(empty(spark))
    assert score_stats(nothing, fit_quality(nothing, none)).count() == 0


# ---- toxicity

BAD = ("idiot", "pathetic", "clown", "scum", "trash", "worthless", "loser", "stupid", "moron", "disgusting")


def test_toxicity_finds_the_inserted_words(spark):
    out = op2_toxicity(spark, MEDIUM).toPandas().set_index("doc_id")
    docs = read_table(spark, MEDIUM, "documents").select("doc_id", "text").toPandas()
    assert sorted(out.index) == sorted(docs["doc_id"])
    assert list(out.columns) == ["p_kind_1", "p_kind_2", "p_kind_3", "p_toxic", "is_toxic"]
    hits = docs.set_index("doc_id")["text"].map(lambda t: len(words_of(t).intersection(BAD)))
    found = out["is_toxic"].reindex(hits.index)
    assert found[hits >= 2].mean() > 0.95
    assert found[hits == 0].mean() < 0.01


def test_toxicity_learns_from_other_rows_than_it_is_judged_on(spark):
    docs = read_table(spark, MEDIUM, "documents").select("doc_id", "text")
    labels = read_table(spark, MEDIUM, "labels")
    right = {}
    for kinds in (0, toxicity.KINDS):
        model = fit_toxicity(docs, labels.where("doc_id % 2 = 0"), kinds=kinds)
        got = score_toxicity(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
        right[kinds] = (got["is_toxic"] == (got["toxic"] == 1)).mean()
    print(f"held-out accuracy without and with the chain: {right}")
    assert min(right.values()) > 0.92 and right[toxicity.KINDS] > right[0] - 0.01


def test_kinds_are_learned_from_the_rows():
    """Two word groups that never meet make two kinds, in rows of all folds; clean rows have none."""
    rng = np.random.default_rng(1)
    x = np.zeros((300, 8))
    group = np.arange(300) % 3
    for row, g in enumerate(group):
        if g < 2:
            x[row, 3 * g + rng.choice(3, 2, replace=False)] = 1
        x[row, 6 + rng.integers(2)] = 1
    folds = rng.integers(0, 3, 300)
    y = (group < 2).astype(float)
    kind = toxicity.toxic_kinds(x, y, folds, np.ones(300), 2)
    assert set(kind[group == 2]) == {-1}
    assert {frozenset(kind[group == g]) for g in (0, 1)} == {frozenset([0]), frozenset([1])}
    assert set(toxicity.toxic_kinds(x, y, folds, np.ones(300), 0)) == {-1}
    same = np.repeat([[1.0, 0], [0, 1.0]], 10, axis=0)
    assert set(toxicity.toxic_kinds(same, same[:, 0], np.arange(20) % 2, np.ones(20), 3)) == {-1, 0}


def test_chain_uses_out_of_fold_probabilities(monkeypatch):
    rng = np.random.default_rng(0)
    x = (rng.random((400, 5)) < 0.5).astype(float)
    first = (x[:, 0] + rng.random(400) > 1.2).astype(float)
    second = (first + x[:, 1] > 1).astype(float)
    folds = np.arange(400) % 3
    seen = []
    real = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda a, y, n: seen.append(a) or real(a, y, n))
    n = np.ones(400)
    weights = fit_chain(x, [first, second], folds, n)
    want = np.zeros(400)
    for k in range(3):
        w = real(x[folds != k], first[folds != k], n[folds != k])
        want[folds == k] = toxicity._predict(w, x[folds == k])
    assert np.allclose(seen[-1][:, 5], want)
    assert weights[0, 6:].tolist() == [0, 0] and weights[1, 6] != 0


def test_logistic_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float)
    n = rng.integers(1, 4, 300).astype(float)
    w = fit_logistic(x, y, n, rounds=50)
    z = np.hstack([np.ones((300, 1)), x])
    gradient = z.T @ (n * (y - toxicity._predict(w, x))) - np.array([1e-6, *[toxicity.RIDGE] * 3]) * w
    assert np.abs(gradient).max() < 1e-6


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    rows = [(7, f"you idiot moron n{'abcdefgh'[k % 8] * (k // 8 + 1)}") for k in range(80)] + [(7, "you idiot moron")] * 200
    rows += [(100 + k, "fine words here" if k % 2 else "stupid moron") for k in range(30)]
    labels = [(7, 1)] + [(100 + k, 1 - k % 2) for k in range(30)]
    seen = []
    real = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda x, t, f, n: seen.append(n.sum()) or real(x, t, f, n))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    fit_toxicity(docs, labels, sample_rows=60)
    # equal rows count once
    fit_toxicity(docs, labels)
    assert seen == [60, 80 + 1 + 30]


@pytest.mark.parametrize("marks", [[], [(1, 1), (5, 1)], [(1, None), (None, 1)]])
def test_toxicity_without_evidence(spark, marks):
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = score_toxicity(awkward(spark), fit_toxicity(awkward(spark), labels)).collect()
    assert len(out) == len(ROWS) and not any(r["is_toxic"] for r in out)
    assert score_toxicity(empty(spark), fit_toxicity(empty(spark), labels)).count() == 0


def test_toxicity_rows(spark):
    rows = [(k, "you idiot moron" if k % 3 == 0 else "fine words here", "c", 1) for k in range(60)] + [
        (1000 + k, t, "c", 1) for k, t in enumerate([None, "", "IDIOT!", "you idiot moron"])] + [(None, "moron idiot", None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, y string, fold int")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] * 2, "doc_id long, toxic int")
    got = [(r["doc_id"], r["is_toxic"]) for r in score_toxicity(df, fit_toxicity(df, labels)).collect()]
    assert len(got) == len(rows) and got.count((None, True)) == 2
    assert {(1000, False), (1001, False), (1003, True)} <= set(got)
