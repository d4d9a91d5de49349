"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each is a logistic model
over the words of the whole text; from the second on, it also sees the
probabilities of all earlier categories. While training, those come from
out-of-fold models, so that a later model learns from the same kind of
probabilities that it meets on new texts. The last category, ``toxic``, is
the label itself; the earlier ones are kinds of toxic rows. No word list names
them: a model of the label, fitted on one fold, weighs the words; that fold's
toxic rows are clustered by their weighted words (spherical k-means), and every
toxic row of the sample belongs to the nearest of the ``KINDS`` centres.

The models see words and word beginnings (so that inflected forms share a
stem), chosen by their association with the label. Models are fitted on a
bounded sample of labelled rows: of the ``SAMPLE_ROWS`` ids with the smallest
hashes, the distinct rows (id and text), and of these the ``SAMPLE_ROWS``
with the smallest hashes, so an id that many rows hold does not lift the
bound. Every text is scored whole, in one pass without a shuffle.

Defined cases: null and empty texts have no words and get the models' base
scores; labels repeated for an id count by their mean; null labels are
ignored; without labels of both classes every probability is 0; a toxic row
without a word of the vocabulary is of no kind, rows at the same distance from
two centres are of the first kind, and with fewer distinct toxic rows than
kinds the last kinds are empty (a probability near 0); repeated
rows and null ids pass through; texts of any length are read whole; further
columns are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, plain, read_table, slices, texts_of

SAMPLE_ROWS = 20_000
VOCABULARY = 400        # words and beginnings that the models see
BEGINNINGS = (4, 5, 6)  # letters of a word beginning
MIN_ROWS = 4            # sampled rows that must hold a word
MIN_Z = 4.0             # association with the label, in standard errors
MEMO_WORDS = 200_000    # words whose parts a task remembers
FOLDS = 3
RIDGE = 0.3
THRESHOLD = 0.5
KINDS = 3               # learned kinds of toxic rows, the earlier categories of the chain
KIND_ROUNDS = 20

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def parts_of(word: str) -> list[str]:
    """The word and its beginnings, which are marked by a hyphen."""
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) >= k)]


class PartFinder:
    """Which of the given words and beginnings a text holds."""

    def __init__(self, vocabulary: tuple[str, ...]) -> None:
        self.place = {w: k for k, w in enumerate(vocabulary)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> set[int]:
        found: set[int] = set()
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        for w in words_of(text):
            hit = self.memo.get(w)
            if hit is None:
                hit = self.memo[w] = tuple(self.place[p] for p in parts_of(w) if p in self.place)
            if hit:
                found.update(hit)
        return found


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: tuple[str, ...]
    categories: tuple[str, ...]
    weights: np.ndarray | None   # a row per category: bias, words, earlier categories

    def probabilities(self, texts: list[str], finder: PartFinder | None = None) -> np.ndarray:
        """A column per category."""
        out = np.zeros((len(texts), len(self.categories)))
        if self.weights is None or not texts:
            return out
        finder = finder or PartFinder(self.vocabulary)
        x = np.zeros((len(texts), len(self.vocabulary)))
        for row, text in enumerate(texts):
            x[row, list(finder(text))] = 1
        for c in range(len(self.categories)):
            out[:, c] = _predict(self.weights[c][:1 + x.shape[1] + c], np.hstack([x, out[:, :c]]))
        return out


def _predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> np.ndarray:
    """Ridge logistic regression of ``n`` like rows each, by Newton steps; bias first."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    pos = (n * y).sum()
    w[0] = math.log((pos + 0.5) / (n.sum() - pos + 0.5))
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = _predict(w, x)
        step = np.linalg.solve((z * (n * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty),
                               z.T @ (n * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_chain(x: np.ndarray, targets: list[np.ndarray], folds: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of each model; later ones are trained on out-of-fold probabilities."""
    v = x.shape[1]
    weights = np.zeros((len(targets), 1 + v + len(targets)))
    earlier = np.zeros((len(x), 0))
    for c, y in enumerate(targets):
        seen = np.hstack([x, earlier])
        out = np.zeros(len(x))
        for k in np.unique(folds):
            rest = folds != k
            out[folds == k] = _predict(fit_logistic(seen[rest], y[rest], n[rest]), seen[folds == k])
        weights[c, :1 + v + c] = fit_logistic(seen, y, n)
        earlier = np.hstack([earlier, out[:, None]])
    return weights


def toxic_kinds(x: np.ndarray, y: np.ndarray, folds: np.ndarray, n: np.ndarray, kinds: int) -> np.ndarray:
    """The kind of each toxic row, and -1 for all other rows; centres are learned on the least fold alone."""
    kind = np.full(len(x), -1)
    first = folds == folds.min()
    signal = x * np.maximum(fit_logistic(x[first], y[first], n[first])[1:], 0)
    length = np.linalg.norm(signal, axis=1)
    usable = (y == 1) & (length > 0)
    learn = usable & first
    if not kinds or not learn.any():
        return kind
    unit = signal / np.where(length > 0, length, 1)[:, None]
    rows, weight = unit[learn], n[learn]
    # the row nearest to the mean, then rows far from all centres
    centres = rows[[np.argmax(rows @ (weight @ rows))]]
    while len(centres) < kinds:
        near = (rows @ centres.T).max(axis=1)
        if near.min() > 1 - 1e-9:
            break
        centres = np.vstack([centres, rows[np.argmin(near)]])
    for _ in range(KIND_ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.array([(weight[nearest == k, None] * rows[nearest == k]).sum(axis=0) for k in range(len(centres))])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        new = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
        if np.allclose(new, centres):
            break
        centres = new
    kind[usable] = (unit[usable] @ centres.T).argmax(axis=1)
    return kind


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
                 kinds: int = KINDS) -> ToxicityModel:
    categories = (*(f"kind_{k + 1}" for k in range(kinds)), "toxic")
    blank = ToxicityModel((), categories, None)
    marks = (plain(labels, {"id": id_col, "y": label_col}).where("id is not null and y is not null")
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    # at most sample_rows narrow rows are broadcast
    rows = materialize(plain(docs, {"id": id_col, "text": text_col}).join(F.broadcast(marks), "id").distinct(), "toxic-sample")
    if rows.count() > sample_rows:
        # ids that several rows hold: only hashes are sorted
        place = F.xxhash64("id", "text")
        last = rows.select(place.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
        rows = rows.where(place <= last)

    def counted(batches):
        # of the sample's rows alone, so the counts of a task are bounded
        rows_with, toxic_with = Counter(), Counter()
        for b in slices(batches):
            for t, y in zip(texts_of(b), b.column(1).to_pylist()):
                parts = {p for w in words_of(t) for p in parts_of(w)}
                rows_with.update(parts)
                if y:
                    toxic_with.update(parts)
        words = list(rows_with)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([rows_with[w] for w in words], pa.int64()),
             pa.array([toxic_with[w] for w in words], pa.int64())], names=["word", "c", "p"])

    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")).first()
    if total["pos"] in (0, total["n"]):
        return blank
    rate = total["pos"] / total["n"]
    # how far the share of toxic rows among those with the word is from that of all rows
    z = (F.col("p") - F.col("c") * F.lit(rate)) / F.sqrt(F.col("c") * F.lit(rate * (1 - rate)))
    vocabulary = tuple(r["word"] for r in (
        rows.select("text", "y").mapInArrow(counted, "word string, c long, p long")
        .groupBy("word").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
        .where(F.col("c") >= MIN_ROWS).withColumn("z", F.abs(z)).where(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "word").limit(VOCABULARY).collect()))
    if not vocabulary:
        return blank

    def sparse(batches):
        finder = PartFinder(vocabulary)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([sorted(finder(t)) for t in texts_of(b)], pa.list_(pa.int32())),
            ], names=["fold", "y", "words"])

    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int").alias("fold")
    # bounded by the sample; rows with the same words count as one row with a weight
    sample = (rows.select(fold, "y", "text")
              .mapInArrow(sparse, "fold int, y int, words array<int>")
              .groupBy("fold", "y", "words").agg(F.count("*").alias("n"))
              .orderBy("fold", "y", "words").collect())
    x = np.zeros((len(sample), len(vocabulary)))
    for k, r in enumerate(sample):
        x[k, r["words"]] = 1
    y = np.array([r["y"] for r in sample], float)
    n = np.array([r["n"] for r in sample], float)
    folds = np.array([r["fold"] for r in sample])
    kind = toxic_kinds(x, y, folds, n, kinds)
    weights = fit_chain(x, [*((kind == k).astype(float) for k in range(kinds)), y], folds, n)
    return ToxicityModel(vocabulary, categories, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, a probability per category, and ``is_toxic`` for every row."""
    rows = plain(docs, {id_col: id_col, "text": text_col})
    fields = [T.StructField(f"p_{c}", T.DoubleType()) for c in model.categories]
    schema = T.StructType([rows.schema[0], *fields, T.StructField("is_toxic", T.BooleanType())])

    def run(batches):
        finder = PartFinder(model.vocabulary)
        for b in slices(batches):
            p = model.probabilities(texts_of(b), finder)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(p[:, c], pa.float64()) for c in range(p.shape[1])),
                 pa.array(p[:, -1] >= THRESHOLD, pa.bool_())], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))
