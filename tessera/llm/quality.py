"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Statistics of the whole text (word shape, repetition, character classes)
are standardised and mapped to random cosine features, whose inner products
approximate a Gaussian kernel. Each partition sums its share of the normal
equations; the sums, whose size depends on the number of features alone,
are added by Spark and solved on the driver. Ridge scores of other labelled
rows, counted in fixed bins, give a monotone step from score to probability
(pool adjacent violators).

Folds: rows with crc32(id as text) mod 3 = 0 fit the ridge, those with 2 the
calibration, those with 1 are held out. Ids, labels, language and source are
no inputs of a score.

Defined cases: null and empty texts have all-zero statistics and a score of
their own; null ids count as the empty id text; labels repeated for an id
are averaged and null labels ignored; without labels of both classes the
score is the base rate (1 where there is none), so nothing is rejected on
no evidence; texts of any length are read whole; a score of exactly one half
counts as good; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import keep_rows, materialize, plain, read_table, slices, texts_of

COSINES = 128
SEED = 20_240
RIDGE = 1e-3
BINS = 1000
LOW, HIGH = -0.5, 1.5   # range of ridge scores that the bins cover; scores beyond go to the end bins

STATS = (
    "log_chars", "log_words", "word_chars", "distinct_words", "repeated_words", "repeated_lines", "upper", "lower",
    "digits", "full_stops", "symbols", "pipes", "exclamations", "line_ends", "non_ascii", "entropy",
)


def text_stats(text: str) -> list[float]:
    """Statistics of a text in the order of ``STATS``; shares are of bytes, words or lines."""
    words = text.split()
    if not words:
        return [0.0] * len(STATS)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    c = np.bincount(raw, minlength=256)
    n, nw = len(raw), len(words)
    lines = text.split("\n")
    p = c[c > 0] / n

    def share(chars: bytes) -> float:
        return float(c[list(chars)].sum()) / n

    return [
        math.log1p(n), math.log1p(nw), min(n / nw, 50.0), len(set(words)) / nw,
        sum(map(operator.eq, words, words[1:])) / nw, 1 - len(set(lines)) / len(lines),
        float(c[65:91].sum()) / n, float(c[97:123].sum()) / n, float(c[48:58].sum()) / n,
        share(b".,"), share(b"#$%&*<>{}\\^~"), share(b"|"), share(b"!"), share(b"\n"),
        float(c[128:].sum()) / n, float(-(p * np.log2(p)).sum()),
    ]


def document_stats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, stats`` for every row."""
    rows = plain(df, {"id": id_col, "text": text_col})
    schema = T.StructType([rows.schema[0], T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text_stats(t) for t in texts_of(b)], type=pa.list_(pa.float64()))],
                names=["id", "stats"])

    return rows.mapInArrow(run, schema)


def fold(id_col: str = "id") -> Column:
    """crc32 of the id as text, mod 3; 1 is held out."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3).cast("int")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None   # None: constant scores
    step_at: np.ndarray          # ridge scores, ascending
    step_to: np.ndarray          # calibrated probabilities there, ascending

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        rng = np.random.default_rng(SEED)
        w = rng.normal(0, 1 / math.sqrt(len(STATS)), (len(STATS), COSINES))
        shift = rng.uniform(0, 2 * math.pi, COSINES)
        return np.hstack([np.ones((len(z), 1)), z, math.sqrt(2) * np.cos(z @ w + shift)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        if self.weights is None:
            return np.full(len(stats), self.step_to[0])
        return np.clip(np.interp(self.raw(stats), self.step_at, self.step_to), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))


def _normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x xT and x y over ``rows`` (stats, y); one partial sum per partition."""
    def run(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = model.features(_matrix(b.column(0)))
            xy = np.hstack([x, b.column(1).to_numpy(zero_copy_only=False)[:, None]])
            total = x.T @ xy if total is None else total + x.T @ xy
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                names=["i", "j", "v"])

    sums = (rows.select("stats", "y").mapInArrow(run, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas())
    d = 1 + len(STATS) + COSINES
    m = np.zeros((d, d + 1))
    m[sums["i"], sums["j"]] = sums["v"]
    return m[:, :d], m[:, d]


def pool_adjacent(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit of weighted means: block centres and their values."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for xi, yi, wi in zip(x, y, w):
        blocks.append([wi, wi * yi, wi * xi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit_quality(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id",
                label_col: str = "quality") -> QualityModel:
    """Fit on ``stats`` (id, stats) and ``labels``; all labelled rows outside the held-out fold count."""
    marks = (plain(labels, {"id": label_id, "y": label_col}).where("y is not null")
             .groupBy("id").agg(F.avg("y").cast("double").alias("y")))
    rows = materialize(stats.join(marks, "id").withColumn("fold", fold()).where("fold <> 1"), "quality-train")
    d = len(STATS)
    moments = (rows.where("fold = 0").select(F.posexplode("stats").alias("k", "v"))
               .groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect())
    base = rows.agg(F.count("y").alias("n"), F.avg("y").alias("p"),
                    F.min("y").alias("lo"), F.max("y").alias("hi")).first()
    mean, scale = np.zeros(d), np.ones(d)
    for r in moments:
        mean[r["k"]], scale[r["k"]] = r["m"], r["s"] if r["s"] and r["s"] > 1e-9 else 1.0
    constant = QualityModel(mean, scale, None, np.zeros(1), np.array([base["p"] if base["n"] else 1.0]))
    if not moments or base["lo"] == base["hi"]:
        return constant

    blank = QualityModel(mean, scale, np.zeros(0), np.zeros(1), np.zeros(1))
    a, b = _normal_equations(rows.where("fold = 0"), blank)
    penalty = RIDGE * a[0, 0] * np.eye(len(a))
    penalty[0, 0] = 0
    model = QualityModel(mean, scale, np.linalg.solve(a + penalty, b), np.zeros(1), np.zeros(1))

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                s = np.clip(model.raw(_matrix(batch.column(0))), LOW, HIGH)
                k = np.minimum((s - LOW) / (HIGH - LOW) * BINS, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(s), batch.column(1)], names=["bin", "s", "y"])

    bins = (rows.where("fold = 2").select("stats", "y").mapInArrow(binned, "bin int, s double, y double")
            .groupBy("bin").agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n"))
            .orderBy("bin").toPandas())
    if not len(bins):
        return constant
    at, to = pool_adjacent(bins["s"].to_numpy(), bins["y"].to_numpy(), bins["n"].to_numpy().astype(float))
    return QualityModel(mean, scale, model.weights, at, to)


def score_stats(stats: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """``id, held_out, score, predicted`` for every row of ``stats``."""
    schema = T.StructType([stats.schema["id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(model.score(_matrix(b.column(1))), pa.float64())], names=["id", "score"])

    return (stats.select("id", "stats").mapInArrow(run, schema)
            .select(F.col("id").alias(id_col), (fold() == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject."""
    def decide():
        return lambda texts: list(
            model.score(np.array([text_stats(t) for t in texts]).reshape(-1, len(STATS))) >= 0.5)

    return keep_rows(docs, text_col, decide)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    stats = materialize(document_stats(read_table(spark, sf_dir, "documents")), "quality-stats")
    return score_stats(stats, fit_quality(stats, read_table(spark, sf_dir, "labels")))
