"""Near-duplicate groups by one-permutation MinHash, bands and star edges.

1. Signatures. A document's set holds the 64-bit hashes of its distinct word
   shingles. One permutation splits the hash range into ``BANDS * ROWS`` bins
   and keeps each bin's least hash; an empty bin borrows from the first
   filled bin of its own fixed random order (optimal densification).
   Documents with the same set become one node here already.
2. Buckets. ``ROWS`` bins make a band; equal bands share a bucket. At a
   similarity of 0.8 a pair shares no bucket with a probability of
   (1 - 0.8^5)^35, less than one in a million.
3. Star edges. Each bucket links its members to one hub, so a bucket of m
   nodes proposes m - 1 pairs. Proposed pairs are confirmed on full sets and
   confirmed links merged to components.
4. Members of a bucket that are still in different components may have a
   link that the hub did not show. They are joined by prefixes: with the
   shingles of each set ordered from rare to frequent, two sets that are
   similar enough share one of the shorter set's first ninth and the longer
   one's first fifth, and so early that enough shingles are left after it.
   Only pairs in different components that share such a shingle are
   compared. The order comes from a table of counts with a fixed number of
   cells; any order gives the same links. So no link between two members of
   a bucket is left out, while members that merely resemble each other (pages
   of one template) differ in their rare shingles and are never paired.
5. Variants of one text share its shingles in their prefixes, linked or not.
   So each set has a sketch, the parities of ``SKETCH_BITS`` classes of its
   shingles. Sketches differ in at most as many bits as sets in shingles, so
   a pair whose sketches differ in more bits than a link allows is none, and
   is dropped where it is met. As one link joins two components, the nearest
   pair of each two is confirmed first, the others only where that one fails
   and no other link has joined the two.

A hub with many pairs meets them in portions of ``PORTION`` members, each
portion with its own copy of the hub's set, so no task holds a whole star; a
shingle that many prefixes hold is dealt to portions in the same way.
Sets are built again for the nodes in proposed pairs alone; the sets of all
documents are never stored.

Defined cases: null texts and texts without words have an empty set and link
with nothing; with fewer words than a shingle, the whole sequence is one
shingle; a null id takes part but names no component unless it is alone;
repeated rows have equal sets and all come back, and one row of each
component is kept; texts of any length are read whole; further columns are left
out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, plain, read_table, slices, text_or_empty, texts_of

THRESHOLD_PERCENT = 80
BANDS = 35
ROWS = 5
BINS = BANDS * ROWS
PORTION = 256          # members of a star that one copy of the hub's set meets
SHARERS = 4096         # holders of a prefix shingle that one task meets at a time
CELL_BITS = 20         # cells of the table of shingle counts, as a power of two
SKETCH_BITS = 2048     # classes of shingles whose parities a sketch holds; tells sets of up to some 2,000 apart

_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; A-Z lower-cased, ASCII white space between words."""
    parts = text.encode("utf-8").lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)
    used = min(n, words)
    # the shingle's length is part of its hash
    out = np.full(n - used + 1, used, np.uint64)
    for k in range(used):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[k:k + len(out)])
    return np.unique(out)


def _borrow_order() -> np.ndarray:
    """For each bin, all bins in an order of its own."""
    rng = np.random.default_rng(BINS)
    return np.argsort(rng.random((BINS, BINS)), axis=1)


_BOUNDS = np.array([(k << 64) // BINS for k in range(BINS)], np.uint64)
_UPPER = np.append(_BOUNDS[1:] - _U(1), _U(0xFFFFFFFFFFFFFFFF))
_ORDER = _borrow_order()
_BAND_SEED = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band from a non-empty, sorted shingle set."""
    at = np.searchsorted(hashes, _BOUNDS)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    filled = (at < len(hashes)) & (least <= _UPPER)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        least = least.copy()
        least[empty] = least[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    rows = least.reshape(BANDS, ROWS)
    key = _BAND_SEED
    for k in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _signatures(rows: DataFrame, words: int) -> DataFrame:
    """``id, sha, n, digest, bands``; empty sets have no digest and no bands."""
    rows = rows.select("id", F.sha2(text_or_empty().cast("binary"), 256).alias("sha"), "text")
    schema = T.StructType([rows.schema["id"], rows.schema["sha"], T.StructField("n", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in slices(batches):
            sets = [shingle_set(t, words) for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(map(len, sets), pa.int64()),
                pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([band_keys(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], names=["id", "sha", "n", "digest", "bands"])

    return rows.mapInArrow(run, schema)


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``digest, hashes`` of the given texts."""
    def run(batches):
        for b in slices(batches):
            sets = [s for s in (shingle_set(t, words) for t in texts_of(b)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(set_digest, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["digest", "hashes"])

    return rows.select("text").mapInArrow(run, "digest binary, hashes binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs`` (hub, node) whose full sets are similar enough."""
    sizes = materialize(pairs.groupBy("hub").agg(F.ceil(F.count("*") / PORTION).alias("portions")), "sizes")
    hubs = sizes.join(sets.select(F.col("node").alias("hub"), F.col("hashes").alias("hub_set")), "hub")
    dealt = (pairs.join(sizes, "hub")
             .withColumn("portion", F.pmod(F.xxhash64("node"), F.col("portions")))
             .select("hub", "portion", "node").join(sets.select("node", "hashes"), "node"))
    copies = hubs.select("hub", "hub_set", F.explode(F.expr("sequence(0L, portions - 1)")).alias("portion"))
    both = dealt.join(copies, ["hub", "portion"]).select("hub", "node", "hub_set", "hashes")

    def run(batches):
        for b in slices(batches, 1024):
            a, c = b.column(2), b.column(3)
            ok = [similar(np.frombuffer(a[k].as_py(), np.uint64), np.frombuffer(c[k].as_py(), np.uint64), percent)
                  for k in range(b.num_rows)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "hub long, node long")


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` (least node reachable) for every node of ``links`` (hub, node)."""
    both = materialize(links.unionByName(links.select(F.col("node").alias("hub"), F.col("hub").alias("node")))
                       .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")),
                         "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        step = materialize(labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next")), "step")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = materialize(step.join(jump, "next", "left")
                          .select("node", "comp", F.least("next", F.coalesce("far", "next")).alias("new")), "labels")
        labels = new.select("node", F.col("new").alias("comp"))
        if new.where("new <> comp").isEmpty():
            return labels


def _linked_nodes(nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, comp`` for the nodes that have a link."""
    spark = nodes.sparkSession
    bands = nodes.select("node", F.explode("bands").alias("key"))
    # Here and below, the grouped side of a join is written first: then both
    # sides are shuffled for the join, and a hot key can be split at runtime.
    hubs = materialize(bands.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("m"))
                       .where("m > 1").drop("m"), "hubs")
    members = materialize(bands.join(hubs, "key").where("node <> hub").select("key", "hub", "node"), "members")

    # sets of the nodes that some bucket holds together with another
    used = members.select("node").unionByName(members.select(F.col("hub").alias("node"))).distinct()
    wanted = materialize(nodes.join(used, "node"), "wanted")
    ids = wanted.select(F.col("id").alias("__id")).distinct().hint("shuffle_hash")
    texts = docs.join(ids, docs["id"].eqNullSafe(F.col("__id")), "left_semi")
    sets = materialize(_sets(texts, words).join(wanted.select("node", "digest"), "digest")
                       .groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")
    lengths = wanted.select("node", "n")

    # sets whose sizes alone rule a link out are not fetched
    stars = (members.select("hub", "node").distinct().join(lengths, "node")
             .join(lengths.select(F.col("node").alias("hub"), F.col("n").alias("hub_n")), "hub")
             .where(F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent).select("hub", "node"))
    links = materialize(_confirmed(materialize(stars, "stars"), sets, percent), "confirmed")
    labels = components(links)
    return _joined_across(members.select("key", "node"), links, labels, sets, percent)


def _joined_across(members: DataFrame, links: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``labels`` after all links between members of a bucket that are in different components."""
    own = members.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    keys = materialize(own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                       .where("lo < hi").select("key"), "open-keys")
    if keys.isEmpty():
        return labels
    open_nodes = own.join(keys, "key", "left_semi").select("node", "comp").distinct()
    opened = materialize(open_nodes.join(sets, "node"), "open")
    pairs = materialize(_prefix_pairs(opened, percent), "across")
    if pairs.isEmpty():
        return labels
    nearest = materialize(pairs.groupBy("lo", "hi").agg(F.min(F.struct("apart", "hub", "node")).alias("p"))
                          .select("lo", "hi", "p.hub", "p.node"), "nearest")
    found = materialize(_confirmed(nearest.select("hub", "node"), opened, percent), "confirmed")
    if not found.isEmpty():
        links = links.unionByName(found)
        labels = components(links)
    apart = (nearest.join(labels.select(F.col("node").alias("lo"), F.col("comp").alias("lo_comp")), "lo", "left")
             .join(labels.select(F.col("node").alias("hi"), F.col("comp").alias("hi_comp")), "hi", "left")
             .where(F.coalesce("lo_comp", "lo") != F.coalesce("hi_comp", "hi")).select("lo", "hi"))
    rest = materialize(pairs.join(apart, ["lo", "hi"], "left_semi").select("hub", "node")
                       .join(nearest, ["hub", "node"], "left_anti"), "rest")
    if rest.isEmpty():
        return labels
    more = materialize(_confirmed(rest, opened, percent), "confirmed")
    return labels if more.isEmpty() else components(links.unionByName(more))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - CELL_BITS)).astype(np.int64)


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold the shingles of each cell; 2 ** CELL_BITS numbers at any size of input."""
    def run(batches):
        seen = np.zeros(1 << CELL_BITS, np.int64)
        for b in slices(batches):
            np.add.at(seen, _cell(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)), 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], names=["cell", "n"])

    table = (sets.select("hashes").mapInArrow(run, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[table["cell"].to_numpy()] = table["n"].to_numpy()
    return counts


def prefix(hashes: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The set's rarest shingles, rare ones first: one of them is in every set that is similar enough."""
    n = len(hashes)
    order = np.lexsort((hashes, counts[_cell(hashes)]))
    return hashes[order[:n - -(-percent * n // 100) + 1]]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the set's classes of shingles, 64 in a number; two sets differ at least where their sketches do."""
    odd = np.bincount((hashes & _U(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(sets: DataFrame) -> DataFrame:
    """``node, sketch``."""
    def run(batches):
        for b in slices(batches):
            found = [sketch(np.frombuffer(h, np.uint64)) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "sketch"])

    return sets.select("node", "hashes").mapInArrow(run, "node long, sketch array<long>")


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, node) in different components (lo, hi) that share a shingle early enough in both prefixes.

    ``apart`` is the number of bits in which their sketches differ, never more than a link allows.
    """
    counts = sets.sparkSession.sparkContext.broadcast(_shingle_counts(sets))

    def run(batches):
        for b in slices(batches, 64):
            found = [np.frombuffer(h, np.uint64) for h in b.column(2).to_pylist()]
            heads = [prefix(h, counts.value, percent) for h in found]
            size = [len(h) for h in heads]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(heads).view(np.int64)),
                pa.array(np.repeat(b.column(0).to_numpy(), size)), pa.array(np.repeat(b.column(1).to_numpy(), size)),
                pa.array(np.repeat([len(h) for h in found], size), pa.int64()),
                pa.array(np.concatenate([np.arange(k) for k in size]), pa.int64()),
            ], names=["shingle", "node", "comp", "n", "at"])

    heads = materialize(sets.select("node", "comp", "hashes")
                        .mapInArrow(run, "shingle long, node long, comp long, n long, at long"), "prefixes")
    # a pair's shorter set holds the shingle where enough are left for a set of its own size
    early = (F.col("n") - F.col("at")) * (100 + percent) >= 2 * percent * F.col("n")
    shared = materialize(heads.groupBy("shingle")
                         .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(early).alias("early"))
                         .where("lo < hi and early").select("shingle"), "shared")
    live = materialize(heads.join(shared, "shingle", "left_semi"), "live")
    # the holders outside a shingle's largest component ask all others
    parts = live.groupBy("shingle", "comp").agg(F.count("*").alias("m"))
    hosts = materialize(parts.groupBy("shingle").agg(F.max(F.struct("m", "comp")).getField("comp").alias("host"),
                                                     F.ceil(F.sum("m") / SHARERS).alias("portions")), "hosts")
    told = materialize(live.join(hosts, "shingle").withColumn("guest", F.col("comp") != F.col("host"))
                       .join(_sketches(sets), "node"), "told")
    a = (told.where("guest").withColumn("portion", F.explode(F.expr("sequence(0L, portions - 1)")))
         .select("shingle", "portion", "node", "comp", "n", "at", "sketch").alias("a"))
    b = (told.withColumn("portion", F.pmod(F.xxhash64("node"), F.col("portions")))
         .select("shingle", "portion", "node", "comp", "n", "at", "guest", "sketch").alias("b"))
    rest = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    both = F.col("a.n") + F.col("b.n")
    apart = F.aggregate(F.zip_with("a.sketch", "b.sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), add)
    fits = ((F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.portion") == F.col("b.portion"))
            & (F.col("a.comp") != F.col("b.comp"))
            # a pair of guests is met once
            & (~F.col("b.guest") | (F.col("a.node") < F.col("b.node")))
            & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
            & (rest * (100 + percent) >= percent * both)
            & (apart * (100 + percent) <= (100 - percent) * both))
    return a.join(b, fits).select(
        F.least("a.node", "b.node").alias("hub"), F.greatest("a.node", "b.node").alias("node"),
        F.least("a.comp", "b.comp").alias("lo"), F.greatest("a.comp", "b.comp").alias("hi"),
        apart.alias("apart")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``id, n_shingles, component_id, kept, text_sha256`` for every row."""
    docs = plain(df, {"id": id_col, "text": text_col})
    rows = materialize(_signatures(docs, shingle_words).withColumn("rid", F.monotonically_increasing_id()),
                       "signatures")
    # documents with equal sets are one node, named by its least row
    nodes = (rows.where("n > 0").groupBy("digest")
             .agg(F.min(F.struct("rid", "id", "n", "bands")).alias("x"))
             .select("digest", F.col("x.rid").alias("node"), F.col("x.id").alias("id"),
                     F.col("x.n").alias("n"), F.col("x.bands").alias("bands")))
    nodes = materialize(nodes, "nodes")
    labels = _linked_nodes(nodes, docs, shingle_words, percent)
    named = nodes.select("digest", "node").join(labels, "node", "left") \
                 .select("digest", F.coalesce("comp", "node").alias("comp"))
    placed = materialize(rows.select("rid", "id", "sha", "n", "digest").join(named, "digest", "left")
                         .select("rid", "id", "sha", "n", F.coalesce("comp", "rid").alias("comp")), "placed")
    # a null id is last, so it names a component and is kept only if no row has an id
    first = materialize(
        placed.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("f")), "first")
    return (placed.join(first, "comp")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.col("f.id").alias("component_id"), (F.col("rid") == F.col("f.rid")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=2)
    # the operator keeps one row of a component; of rows that share its id, the contract's column takes all
    return rows.withColumn("row_kept", F.col("kept")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
