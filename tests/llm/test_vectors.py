"""Vector codes and hard negatives: brute force in plain Python, twins, awkward rows, pruning."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from tessera.llm import hard_negatives
from tessera.llm.hard_negatives import (
    OP13_SQL, TopLists, _LAST_ID, anchor_block, find_negatives, find_positives, mine_hard_negatives, op13_hard_negatives,
    walk,
)
from tessera.llm.vector_codes import (
    OP12_SQL, choose_pivots, compress_vectors, nearest_entries, op12_vector_codes, with_label_error, _distances,
)
from tessera.llm import vector_codes
from tessera.llm.vectors import integer_vectors

from .helpers import same_rows

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id double, d int, n long"
MEDIUM = "/root/testdata/sf0.01"


def table(n=300, length=32, seed=0, labels=4):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(0, 0.1, length).astype(np.float32).tolist(), int(rng.integers(labels)), "x", 1.0, 2, 3)
            for k in range(n)]
    for k in range(20, 26):  # copies: ties
        rows[k] = (k, rows[10][1], rows[10][2], "x", 1.0, 2, 3)
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 1, None, None, None, None), (1001, [], 1, "x", 1.0, 2, 3),
             (1002, [nan] * length, 1, "x", 1.0, 2, 3), (1003, [inf] + [0.0] * (length - 1), 1, "x", 1.0, 2, 3),
             (1004, [None] + [0.0] * (length - 1), 1, "x", 1.0, 2, 3), (1005, [0.5] * (length + 16), 1, "x", 1.0, 2, 3),
             (1006, [0.0] * length, None, "x", 1.0, 2, 3), (1100, [0.0] * length, 0, "x", 1.0, 2, 3),
             (1200, [-0.0] * length, 0, "x", 1.0, 2, 3), (None, rows[3][1], 2, "x", 1.0, 2, 3),
             (None, rows[3][1], None, "x", 1.0, 2, 3)]
    return rows


def usable(rows, length=32):
    return [(r[0], [math.floor(256 * float(x)) for x in r[1]], r[2]) for r in rows
            if r[1] is not None and len(r[1]) == length and all(x is not None and math.isfinite(x) for x in r[1])]


def codes_by_hand(rows, parts=16, rounds=2):
    kept = usable(rows)
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    first = {}
    for id, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(id, cut(v))
    books = [[v[p] for v in list(first.values())[:64]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(nearest(p, cut(v)[p])[1], []).append(cut(v)[p])
            new.append([[sum(c) // len(c) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])])
        books = new
    out, sums = [], {}
    for id, v, label in kept:
        found = [nearest(p, x) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((id, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(id, code, error, sums[label], digest) for id, code, error, label in out]


@pytest.mark.parametrize("n", [40, 200])
def test_codes_against_plain_python(spark, n):
    rows = table(n)
    rows.append(rows[5])
    codes, books = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = [(r["id"], r["code"], r["error"], r["label_error"], books.sha256()) for r in with_label_error(codes).collect()]
    assert same_rows(got, codes_by_hand(rows))


def test_many_labels_join_the_same(spark, monkeypatch):
    codes, _ = compress_vectors(spark.createDataFrame(table(60), SCHEMA))
    want = with_label_error(codes).collect()
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert same_rows(with_label_error(codes).collect(), want)


def test_no_usable_rows(spark):
    for rows in ([], table(40)[40:45], [(None, [0.5] * 32, 1, "x", 1.0, 2, 3)]):
        df = spark.createDataFrame(rows, SCHEMA)
        codes, books = compress_vectors(df)
        assert codes.count() == 0 and books is None
        assert mine_hard_negatives(df, df["vec_id"] % 100 == 0).count() == 0
    short = spark.createDataFrame([(1, [0.5] * 17, 1)], "vec_id long, embedding array<float>, label int")
    assert compress_vectors(short)[0].count() == 0
    with pytest.raises(ValueError, match="too large"):
        integer_vectors(spark.createDataFrame([(1, [1e30] * 16)], "id long, e array<float>"), {"id": "id"}, "e")


def test_pivots_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (64, 4))
    x = centres[rng.integers(0, 64, 500)] + rng.integers(-20, 20, (500, 4))
    entries = centres + 1
    pivots = choose_pivots(entries[None], 4)[0]
    code, best, seen = nearest_entries(x, _distances(x, pivots).astype(np.float32).astype(float), entries, pivots)
    d = ((x[:, None] - entries[None]) ** 2).sum(-1)
    assert (code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert seen < 500 * 64 / 8
    same = np.repeat(entries[:1], 64, axis=0)  # all equal: the lowest number
    assert (nearest_entries(x, _distances(x, same[:4]), same, same[:4])[0] == 0).all()


def negatives_by_hand(rows):
    kept = [(id, v, (label + 1) % 10 if id is not None and id % 7 == 0 else label)
            for id, v, label in usable(rows) if label is not None]
    anchors = {(id, tuple(v), label) for id, v, label in kept if id is not None and id % 100 == 0}
    out = []
    for id, v, label in anchors:
        scored = sorted(((sum(a * b for a, b in zip(v, w)), o, l) for o, w, l in kept if o != id),
                        key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for ps, pid, _ in [s for s in scored if s[2] == label][:5]:
            band = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(id, pid, k, nid, ps, ns) for k, (ns, nid, _) in enumerate(band, 1)]
    return out


def mined(df):
    from pyspark.sql import functions as F

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine_hard_negatives(df.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize("bytes_, seed, labels", [(4 << 20, 0, 4), (700, 1, 2), (4 << 20, 2, 1)])
def test_negatives_against_plain_python(spark, monkeypatch, bytes_, seed, labels):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", bytes_)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    monkeypatch.setattr(hard_negatives, "STEP", 8)
    rows = table(500, seed=seed, labels=labels)
    rows += [rows[7], rows[100]]
    assert same_rows(mined(spark.createDataFrame(rows, SCHEMA).repartition(3)), negatives_by_hand(rows))


def test_members_stop_early_on_clustered_rows():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    centres = rng.normal(0, 60, (40, 32))
    which = rng.integers(0, 40, 4000)
    x = np.floor(centres[which] + rng.normal(0, 3, (4000, 32)))
    ids, labels = np.arange(4000), which % 4
    anchors = np.arange(0, 4000, 100)
    block = anchor_block(pa.table({"id": ids[anchors], "label": labels[anchors],
                                   "v": [r.astype(int).tolist() for r in x[anchors]]}), 32, np.float64)
    known = {v: k for k, v in enumerate(block.labels.to_pylist())}
    index = np.array([known.get(v, -1) for v in labels])
    top = TopLists(len(anchors), 5)

    def offer(members, cand, scores):
        m, c = np.nonzero(cand[None, :] != block.ids[members][:, None])
        top.offer(members[m], scores[m, c], cand[c])

    taken = walk(block, True, x, ids, index, offer, lambda m, bound: top.last[m] <= bound)
    own = (labels[anchors][:, None] == labels[None, :]).sum()
    assert taken < own / 1.5
    whole = find_positives(block, iter([(x, ids, index)]), 5)
    assert (whole.scores == top.scores).all()
    block.positives = whole
    scores = (x[anchors] @ x.T).astype(int)
    found = find_negatives(block, iter([(x[:2000], ids[:2000], index[:2000]), (x[2000:], ids[2000:], index[2000:])]), 10, (30, 90))
    for a in range(len(anchors)):
        for place in range(5):
            p = whole.scores[a, place]
            fits = [(-scores[a, k], k) for k in range(4000) if labels[k] != labels[anchors[a]]
                    and 30 * p <= 100 * scores[a, k] <= 90 * p]
            got = [(-s, k) for s, k in zip(found.scores[a * 5 + place], found.ids[a * 5 + place]) if k != _LAST_ID]
            assert got == sorted(fits)[:10]


@pytest.mark.parametrize("query, sql", [(op12_vector_codes, OP12_SQL), (op13_hard_negatives, OP13_SQL)])
def test_twins(spark, query, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{MEDIUM}/embeddings.parquet')")
    want, got = con.execute(sql), query(spark, MEDIUM)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert same_rows([tuple(r) for r in got.select(*names).collect()], want.fetchall())
