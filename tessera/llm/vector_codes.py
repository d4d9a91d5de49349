"""Vector code compression: product codes, assigned with LAESA pivots.

A vector's integer components are cut into equal parts; each part is
replaced by the number of the nearest entry (squared Euclidean distance, ties
to the lower number) in the codebook of its position. Codebooks start from
the parts of the first vectors and are refined by a few rounds of Lloyd's
method in integers: every entry becomes the floored mean of its parts, an
entry without parts stays.

Every part position has a few fixed pivots, taken from the first codebook
(each the farthest from those before). The distances of all parts to their
pivots are computed once and written beside the vectors. In a round only the
distances of pivots and entries are new: the differences
``|d(part, pivot) - d(entry, pivot)|`` bound the distance of part and entry
from below. A part tries entries in the order of their bounds, with exact
integer distances, until no bound left can reach the best distance found
(bounds are lowered by more than their rounding error, so a tie is tried).

Rounds run as Arrow batches; a task returns sums and counts per entry, which
Spark adds up. Only these sums (parts x entries rows) and the codebooks reach
the driver, whatever the size of the table. The vectors are written once to
the shared folder, so that a lost executor costs its running tasks only.

Defined cases: rows whose vector is null, empty, holds null or non-finite
components, or has another length than most rows, are dropped, as is every
row if that length is no multiple of the number of parts (see
``vectors.integer_vectors``). The first codebook takes each id once: of rows
that share an id the smallest vector, and never a null id; rows with a null
id are encoded like others. With fewer ids than entries the codebook is
smaller. Repeated rows are encoded each; equal distances go to the lower
entry; null labels form one group; an empty table gives an empty result.
Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, read_table, slices
from tessera.llm.vectors import integer_vectors, lists, matrix

PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
# vectors of one Arrow batch that are assigned at a time
ROWS = 2048
# labels whose summed errors may be broadcast (their rows are of some 30 bytes); more are joined by salted keys
BROADCAST_LABELS, SALTS = 100_000, 16


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (part, entry, component), as integers; ``pivots`` (part, pivot, component), fixed."""

    entries: np.ndarray
    pivots: np.ndarray

    def sha256(self) -> str:
        """Digest of the decimal components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of two matrices."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1).astype(np.float64))


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Per part: the first entry, then each time the entry farthest from the pivots so far."""
    out = []
    for part in entries:
        taken = [0]
        while len(taken) < min(count, len(part)):
            taken.append(int(np.argmax(_distances(part, part[taken]).min(axis=1))))
        out.append(part[taken])
    return np.array(out)


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
                    pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and squared distance for the parts ``x`` of one position.

    ``to_pivots`` holds the parts' distances to the pivots. The third value is
    the number of exact evaluations.
    """
    of_entries = _distances(pivots, entries)
    n, seen = len(x), 0
    bound = np.zeros((n, len(entries)))
    for k in range(len(pivots)):
        own, other = to_pivots[:, k, None], of_entries[None, k, :]
        # distances to pivots are kept as 32-bit floats: the margin is above their rounding
        np.maximum(bound, np.abs(own - other) - 1e-6 * (own + other), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1) ** 2
    best, code = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    active = np.arange(n)
    for step in range(len(entries)):
        active = active[bound[active, step] <= best[active]]
        if not len(active):
            break
        entry = order[active, step]
        d = ((x[active] - entries[entry]) ** 2).sum(-1)
        seen += len(active)
        better = (d < best[active]) | ((d == best[active]) & (entry < code[active]))
        hit = active[better]
        best[hit], code[hit] = d[better], entry[better]
    return code, best, seen


def _with_pivots(rows: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """The rows with ``d``: each part's distances to its position's pivots."""
    parts, pivots, width = books.pivots.shape

    def run(batches):
        for b in slices(batches, ROWS):
            x = matrix(b, "v", length).reshape(-1, parts, width)
            d = np.stack([_distances(x[:, p], books.pivots[p]) for p in range(parts)], axis=1)
            columns = [*b.columns, lists(d.reshape(len(x), -1), pa.float32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "d"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add("d", T.ArrayType(T.FloatType())))


def _assigned(batches, books: Codebooks, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with their parts, the parts' entries and squared distances."""
    parts, pivots, width = books.pivots.shape
    for b in slices(batches, ROWS):
        x = matrix(b, "v", length).reshape(-1, parts, width)
        d = matrix(b, "d", parts * pivots, np.float64).reshape(-1, parts, pivots)
        found = [nearest_entries(x[:, p], d[:, p], books.entries[p], books.pivots[p])[:2] for p in range(parts)]
        yield b, x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _refined(rows: DataFrame, books: Codebooks, length: int) -> Codebooks:
    """Codebooks whose entries are the floored means of the parts assigned to them."""
    parts, entries, width = books.entries.shape

    def run(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, x, code, _ in _assigned(batches, books, length):
            for p in range(parts):
                np.add.at(sums[p], code[:, p], x[:, p])
                counts[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e], pa.int64()),
             lists(sums[p, e], pa.int64())], names=["part", "entry", "n", "sums"])

    partial = rows.mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[w]) for w in range(width)]).alias("sums")).collect()
    new = books.entries.copy()
    for row in total:
        new[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return Codebooks(new, books.pivots)


def compress_vectors(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                     id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """``id, label, code, error`` of every usable row, and the codebooks (none for an empty table).

    ``code`` has two hex digits a part; ``error`` is the row's squared distance to its entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    given, length, _ = integer_vectors(df, {"id": id_col, "label": label_col}, vector_col)
    schema = T.StructType(given.schema.fields[:2]).add("code", T.StringType()).add("error", T.LongType())
    if not length or length % parts:
        return df.sparkSession.createDataFrame([], schema), None
    ids = [r["id"] for r in given.where("id is not null").select("id").distinct().orderBy("id").limit(entries).collect()]
    if not ids:
        return df.sparkSession.createDataFrame([], schema), None
    first = given.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books = Codebooks(start, choose_pivots(start, PIVOTS))
    rows = materialize(_with_pivots(given, books, length), "vector-parts")
    for _ in range(rounds):
        books = _refined(rows, books, length)

    def run(batches):
        for b, _, code, error in _assigned(batches, books, length):
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(error.sum(axis=1), pa.int64())],
                names=schema.names)

    return rows.mapInArrow(run, schema), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels (nulls are equal); read twice."""
    sums = materialize(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    other = sums.withColumnRenamed("label", "__label")
    if sums.count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(other), codes["label"].eqNullSafe(other["__label"])).drop("__label")
    salted = codes.withColumn("__salt", F.pmod(F.xxhash64("code", "id"), F.lit(SALTS)))
    other = other.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(other, salted["label"].eqNullSafe(other["__label"])
                       & (salted["__salt"] == other["__at"])).drop("__label", "__salt", "__at")


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    codes, books = compress_vectors(read_table(spark, sf_dir, "embeddings"))
    rows = with_label_error(materialize(codes, "vector-codes"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                       F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


_ROUND = """
    near{k} AS (
        SELECT vec_id, p, MIN(d * 64 + e) % 64 AS e, MIN(d * 64 + e) // 64 AS d
        FROM (SELECT x.vec_id, x.p, b.e, SUM((x.x - b.c) * (x.x - b.c))::BIGINT AS d
              FROM comps x JOIN book{k} b ON b.p = x.p AND b.w = x.w
              GROUP BY x.vec_id, x.p, b.e)
        GROUP BY vec_id, p)"""
_MEANS = """
    book{next} AS (
        SELECT b.p, b.e, b.w, COALESCE(m.c, b.c) AS c
        FROM book{k} b LEFT JOIN (
            SELECT n.p, n.e, x.w, FLOOR(SUM(x.x)::DOUBLE / COUNT(*))::BIGINT AS c
            FROM near{k} n JOIN comps x ON x.vec_id = n.vec_id AND x.p = n.p
            GROUP BY n.p, n.e, x.w) m ON m.p = b.p AND m.e = b.e AND m.w = b.w)"""

OP12_SQL = """
WITH kept AS (
        SELECT vec_id, label, embedding AS v, len(embedding) // 16 AS width,
               row_number() OVER (ORDER BY vec_id) - 1 AS nth
        FROM embeddings
        WHERE len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    spread AS (SELECT vec_id, nth, width, v, unnest(range(len(v))) AS k FROM kept),
    comps AS (SELECT vec_id, nth, k // width AS p, k % width AS w, floor(v[k + 1]::DOUBLE * 256)::BIGINT AS x FROM spread),
    book0 AS (SELECT p, nth AS e, w, x AS c FROM comps WHERE nth < 64),""" + ",".join(
    [_ROUND.format(k=0), _MEANS.format(k=0, next=1), _ROUND.format(k=1), _MEANS.format(k=1, next=2),
     _ROUND.format(k=2)]) + """,
    coded AS (
        SELECT k.vec_id, k.label, string_agg(printf('%02x', n.e::INTEGER), '' ORDER BY n.p) AS code,
               SUM(n.d)::BIGINT AS error
        FROM kept k JOIN near2 n ON n.vec_id = k.vec_id
        GROUP BY k.vec_id, k.label)
SELECT vec_id, code, error, (SUM(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, w)) FROM book2) AS codebooks_sha256
FROM coded
"""
