"""Hard-negative mining: anchor clusters that share candidate lists (MAXIMUS style).

An anchor's positives are its best rows of the same label; for each of these
the negatives are the best rows of other labels whose score lies in a band
below the positive's. A score is the integer inner product with the anchor.

Anchors of one label are clustered by direction. For a cluster with centre
``c`` and largest member angle ``t``, a candidate of norm ``n`` at an angle
``a`` to the centre scores at most ``|u| * n * cos(max(0, a - t))`` for any
member ``u``. A block of candidates is sorted by this bound once a cluster;
every member walks the sorted list, some hundred candidates a step, and stops
where ``|u|`` times the next bound certifies that nothing better follows: it
is below the last place of the member's list (a tie goes on, as it may have a
smaller id), or below its band. Lists go on from block to block of a task, so
later blocks stop sooner.

Candidates stay in their partitions and are never shuffled: anchors come to
them in blocks of ``ANCHOR_BYTES``, each broadcast by itself, so that what a
task or the driver holds has a bound that does not grow with the table. A
pass over the candidates finds a block's positives, a second one, which then
knows their scores, the negatives. A task returns at most one full list per
anchor (and positive); Spark ranks these. Each block's result is written to
the shared folder before the next begins.

Defined cases: rows with a null label, with a vector that is null, empty, or
holds null or non-finite components, or of another length than most rows take
no part. A row with a null id is a candidate, after all others of its score,
and never an anchor. Repeated rows are candidates each; equal anchor rows are
one anchor; a row with the anchor's own id is none of its candidates. Equal
scores are ranked by id. A band of a negative score is empty. An empty table,
or one without anchors, gives an empty result. Ids are integers; columns
beside id, label and vector, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, read_table, slices
from tessera.llm.vectors import integer_vectors, matrix

POSITIVES, NEGATIVES = 5, 10
# percent of the positive's score that a negative may have
BAND = (30, 90)
# components of a block of anchors, as 8-byte numbers
ANCHOR_BYTES = 4 << 20
# candidates that are sorted at a time, and that a member of a cluster scores at a time
BLOCK_ROWS, STEP = 8192, 512

_NONE = np.iinfo(np.int64).min
_LAST_ID = np.iinfo(np.int64).max


class TopLists:
    """The best ``width`` (score, id) pairs of many lists: higher scores first, then smaller ids."""

    def __init__(self, lists: int, width: int) -> None:
        self.width = width
        self.scores = np.full((lists, width), _NONE, np.int64)
        self.ids = np.full((lists, width), _LAST_ID, np.int64)

    @property
    def last(self) -> np.ndarray:
        """Score of each list's last place (the least number while it is free)."""
        return self.scores[:, -1]

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(lists)
        old = np.repeat(touched, self.width)
        held, held_ids = self.scores[touched].reshape(-1), self.ids[touched].reshape(-1)
        filled = held != _NONE
        lists = np.concatenate([old[filled], lists])
        scores, ids = np.concatenate([held[filled], scores]), np.concatenate([held_ids[filled], ids])
        order = np.lexsort((ids, -scores, lists))
        lists = lists[order]
        place = np.arange(len(lists)) - np.searchsorted(lists, lists, side="left")
        kept = place < self.width
        self.scores[touched], self.ids[touched] = _NONE, _LAST_ID
        self.scores[lists[kept], place[kept]] = scores[order][kept]
        self.ids[lists[kept], place[kept]] = ids[order][kept]


@dataclass(frozen=True)
class Cluster:
    label: int          # index in the block's labels
    members: np.ndarray  # anchors, by index in the block
    centre: np.ndarray
    angle: float        # largest angle of a member to the centre


@dataclass
class AnchorBlock:
    """Anchors of one broadcast, clustered by label and direction; ``positives`` once they are known."""

    ids: np.ndarray
    labels: pa.Array
    vectors: np.ndarray
    norms: np.ndarray
    clusters: list[Cluster]
    positives: TopLists | None = None


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1, norms)


def cluster_anchors(vectors: np.ndarray, label: int, index: np.ndarray, rounds: int = 3) -> list[Cluster]:
    """Some sqrt(n) clusters of one label's anchors by direction, after a few rounds of spherical k-means."""
    unit = _unit(vectors.astype(np.float64))
    count = math.isqrt(len(unit) - 1) + 1
    centres = unit[np.linspace(0, len(unit) - 1, count).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        centres = np.where(np.any(sums != 0, axis=1, keepdims=True), _unit(sums), centres)
    nearest = np.argmax(unit @ centres.T, axis=1)
    out = []
    for c in np.unique(nearest):
        mine = nearest == c
        cosine = np.clip(unit[mine] @ centres[c], -1, 1)
        out.append(Cluster(label, index[mine], centres[c], float(np.arccos(cosine.min()))))
    return out


def anchor_block(table: pa.Table, length: int, exact: type) -> AnchorBlock:
    """Columns ``id, label, v`` as a block."""
    ids = np.asarray(table.column("id").combine_chunks().to_numpy(zero_copy_only=False), np.int64)
    label = table.column("label").combine_chunks()
    labels = pc.unique(label)
    which = pc.index_in(label, value_set=labels).to_numpy(zero_copy_only=False)
    vectors = matrix(table, "v", length, exact)
    clusters = []
    for k in range(len(labels)):
        index = np.nonzero(which == k)[0]
        clusters += cluster_anchors(vectors[index], k, index)
    return AnchorBlock(ids, labels, vectors, np.linalg.norm(vectors.astype(np.float64), axis=1), clusters)


def candidate_order(cluster: Cluster, x: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates by descending upper bound of a score per unit of an anchor's norm, and the bounds."""
    cosine = np.clip((x @ cluster.centre) / np.where(norms == 0, 1, norms), -1, 1)
    bound = norms * np.cos(np.maximum(0.0, np.arccos(cosine) - cluster.angle))
    # above the rounding of the angles: an arc cosine near 1 loses half of the digits
    bound += norms * 1e-7 + 1e-9
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(block: AnchorBlock, same_label: bool, x: np.ndarray, ids: np.ndarray, labels: np.ndarray,
         offer, open_below) -> int:
    """Every anchor walks its cluster's list over the candidates ``x``.

    ``offer(members, candidate ids, scores)`` takes a step's scores;
    ``open_below(members, bounds)`` tells which members go on when nothing
    that follows scores above ``bounds``. Returns the number of scores taken.
    """
    norms = np.linalg.norm(x.astype(np.float64), axis=1)
    taken = 0
    for cluster in block.clusters:
        chosen = np.nonzero((labels == cluster.label) == same_label)[0]
        if not len(chosen):
            continue
        order, bound = candidate_order(cluster, x[chosen], norms[chosen])
        chosen = chosen[order]
        members, at = cluster.members, 0
        members = members[open_below(members, block.norms[members] * bound[0])]
        while len(members) and at < len(chosen):
            step = chosen[at:at + STEP]
            offer(members, ids[step], (block.vectors[members] @ x[step].T).astype(np.int64))
            taken += len(members) * len(step)
            at += STEP
            if at < len(chosen):
                members = members[open_below(members, block.norms[members] * bound[at])]
    return taken


def find_positives(block: AnchorBlock, parts: Iterator[tuple], width: int) -> TopLists:
    """Best candidates of the anchors' own labels over all ``parts`` (vectors, ids, label indexes)."""
    top = TopLists(len(block.ids), width)

    def offer(members, ids, scores):
        fits = (scores >= top.last[members][:, None]) & (ids[None, :] != block.ids[members][:, None])
        m, c = np.nonzero(fits)
        if len(m):
            top.offer(members[m], scores[m, c], ids[c])

    for x, ids, labels in parts:
        walk(block, True, x, ids, labels, offer, lambda members, bound: top.last[members] <= bound)
    return top


def find_negatives(block: AnchorBlock, parts: Iterator[tuple], width: int, band: tuple[int, int]) -> TopLists:
    """Best candidates of other labels in the band of each positive; list ``anchor * positives + place``."""
    places = block.positives.width
    positive = block.positives.scores.reshape(-1)
    # a list that nothing can enter: no such positive, or one of a negative score
    closed = positive < 0
    low, high = band[0] * positive.clip(0), band[1] * positive.clip(0)
    top = TopLists(len(positive), width)

    def offer(members, ids, scores):
        hundred = 100 * scores
        for place in range(places):
            lists = members * places + place
            least = np.maximum(top.last[lists], np.where(closed[lists], _LAST_ID, _NONE))
            m, c = np.nonzero((hundred >= low[lists][:, None]) & (hundred <= high[lists][:, None])
                              & (scores >= least[:, None]))
            if len(m):
                top.offer(lists[m], scores[m, c], ids[c])

    def open_below(members, bound):
        lists = members[:, None] * places + np.arange(places)
        goes_on = ~closed[lists] & (top.last[lists] <= bound[:, None]) & (low[lists] <= 100 * bound[:, None])
        return goes_on.any(axis=1)

    for x, ids, labels in parts:
        walk(block, False, x, ids, labels, offer, open_below)
    return top


def _parts(batches, block: AnchorBlock, length: int, exact: type) -> Iterator[tuple]:
    for b in slices(batches, BLOCK_ROWS):
        ids = b.column(0)
        ids = pc.fill_null(ids, int(_LAST_ID)).to_numpy(zero_copy_only=False)
        labels = pc.fill_null(pc.index_in(b.column(1), value_set=block.labels), -1).to_numpy(zero_copy_only=False)
        yield matrix(b, "v", length, exact), ids, labels


def _best(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= width)


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == _LAST_ID)


def mine_hard_negatives(df: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                        band: tuple[int, int] = BAND, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` tells, over the columns of ``df``, which rows are anchors.
    """
    spark = df.sparkSession
    given = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                      F.col(f"`{vector_col}`").alias("vector"), anchors.alias("anchor")).where("label IS NOT NULL")
    rows, length, largest = integer_vectors(given, {"id": "id", "label": "label", "anchor": "anchor"}, "vector")
    rows = materialize(rows, "integer-vectors")
    # doubles hold the integers exactly while a hundredfold score stays below 2^53
    exact = np.float64 if 100 * length * largest ** 2 < 1 << 53 else np.int64
    chosen = materialize(rows.where("anchor AND id IS NOT NULL").select("id", "label", "v").distinct(), "anchors")
    blocks = max(1, math.ceil(chosen.count() * length * 8 / ANCHOR_BYTES))
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)))
    candidates = rows.select("id", "label", "v")
    out = []
    for k in range(blocks):
        block = anchor_block(chosen.where(F.col("block") == k).select("id", "label", "v").toArrow(), length, exact)
        if not len(block.ids):
            continue
        _add_positives(candidates, block, positives, length, exact)
        out.append(_negatives(spark, candidates, block, negatives, band, length, exact))
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, "
              "positive_score long, negative_score long")
    if not out:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, out)


def _add_positives(candidates: DataFrame, block: AnchorBlock, width: int, length: int, exact: type) -> None:
    """Fills in ``block.positives``: at most ``width`` rows an anchor of the block come to the driver."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        own = shared.value
        top = find_positives(own, _parts(batches, own, length, exact), width)
        at, place = np.nonzero(top.scores != _NONE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(top.scores[at, place], pa.int64()), _ids(top.ids[at, place])],
            names=["anchor", "score", "id"])

    best = _best(candidates.mapInArrow(run, "anchor int, score long, id long"), ["anchor"], width).collect()
    shared.destroy()
    block.positives = TopLists(len(block.ids), width)
    for r in best:
        block.positives.scores[r["anchor"], r["rank"] - 1] = r["score"]
        block.positives.ids[r["anchor"], r["rank"] - 1] = _LAST_ID if r["id"] is None else r["id"]


def _negatives(spark, candidates: DataFrame, block: AnchorBlock, width: int, band: tuple[int, int],
               length: int, exact: type) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)
    names = ["list", "anchor_id", "positive_id", "positive_score", "score", "id"]
    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "list" else T.LongType()) for n in names])

    def run(batches):
        own = shared.value
        top = find_negatives(own, _parts(batches, own, length, exact), width, band)
        lists, place = np.nonzero(top.scores != _NONE)
        anchor, nth = np.divmod(lists, own.positives.width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.int32()), pa.array(own.ids[anchor], pa.int64()),
             _ids(own.positives.ids[anchor, nth]), pa.array(own.positives.scores[anchor, nth], pa.int64()),
             pa.array(top.scores[lists, place], pa.int64()), _ids(top.ids[lists, place])], names=names)

    best = _best(candidates.mapInArrow(run, schema), ["list"], width)
    found = materialize(best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                    "positive_score", F.col("score").alias("negative_score")), "hard-negatives")
    shared.destroy()
    return found


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH ints AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               list_inner_product(a.v, c.v)::BIGINT AS score
        FROM ints a JOIN ints c ON c.vec_id <> a.vec_id
        WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
