"""Exact deduplication by deterministic block naming.

Texts (each run of white space made one space) are cut into blocks of a
fixed size. The distinct blocks are sorted, by 64-bit hash and then by
content, and named by their places in that order; that is the only time
that text is shuffled. Then adjacent names are paired, the distinct pairs
sorted and named likewise, until one name is left of each document. Equal
names (after equally many rounds) mean equal texts: every name stands for
one content, as it was given by comparing contents.

Occurrences look their block's name up by its hash. Whether two contents
share a hash is seen in the sorted order; if so, all blocks are hashed anew
with the next seed, until no two do.

The rounds run on distinct block sequences, counted before any shuffle, so
a text that a third of all rows hold is one sequence. The groups of equal
texts, their sizes and the ids they keep are taken from the names.

Defined cases: a null text equals the empty one; rows that repeat id and
text all come back, and one of them is kept; a null id stays only where the
whole group has no other; texts of any length are compared whole; further
columns are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, plain, read_table, text_or_empty

BLOCK_CHARS = 8192
SORT_BUCKETS = 65_536
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalized() -> Column:
    return F.regexp_replace(text_or_empty(), SPACE_RUN, " ")


def _blocks(norm: str, size: int) -> Column:
    last = f"cast(greatest(ceil(length({norm}) / {size}), 1) as int) - 1"
    return F.expr(f"transform(sequence(0, {last}), i -> substring({norm}, i * {size} + 1, {size}))")


def _hashed(norm: str, size: int, seed: int) -> Column:
    return F.transform(_blocks(norm, size), lambda b: F.xxhash64(F.lit(seed), b))


def _names(df: DataFrame, bucket: Column, order: list[str]) -> DataFrame:
    """``df`` (distinct rows) with ``name``: the place in sorted order inside
    a hash bucket, and the bucket in the high bits."""
    w = Window.partitionBy("__bucket").orderBy(*order)
    return (df.withColumn("__bucket", F.pmod(bucket, F.lit(SORT_BUCKETS)))
            .withColumn("name", F.shiftleft(F.col("__bucket"), 40).bitwiseOR(F.row_number().over(w).cast("long")))
            .withColumn("shared", F.coalesce(F.lag(order[0]).over(w) == F.col(order[0]), F.lit(False))
                        if len(order) > 1 else F.lit(False))
            .drop("__bucket"))


def _name_blocks(texts: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Names of all distinct blocks by hash, and the seed that keeps hashes apart."""
    for seed in count():
        blocks = (texts.select(F.explode(_blocks("norm", size)).alias("block"))
                  .select(F.xxhash64(F.lit(seed), "block").alias("h"), "block").distinct())
        named = materialize(_names(blocks, F.col("h"), ["h", "block"]).select("h", "name", "shared"), "blocks")
        if named.where("shared").isEmpty():
            return named.drop("shared"), seed


def identities(classes: DataFrame, block_names: DataFrame) -> DataFrame:
    """``cid, n, name``: the one name of each block sequence, and its block count."""
    cur = (classes.select("cid", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
           .join(block_names, "h").select("cid", "n", F.col("n").alias("left"), "pos", "name"))
    cur = materialize(cur, "names0")
    done = cur.where("n = 1").select("cid", "n", "name")
    most = cur.agg(F.max("n")).first()[0] or 1
    while most > 1:
        pairs = (cur.where("`left` > 1")
                 .groupBy("cid", "n", "left", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
                 .withColumn("left", F.expr("cast((`left` + 1) div 2 as int)")))
        pairs = materialize(pairs, "pairs")
        named = _names(pairs.select("a", "b").distinct(), F.xxhash64("a", "b"), ["a", "b"]).drop("shared")
        cur = materialize(pairs.join(named, ["a", "b"]).select("cid", "n", "left", "pos", "name"), "names")
        done = done.unionByName(cur.where("`left` = 1").select("cid", "n", "name"))
        most = (most + 1) // 2
    return done


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256, identity`` for every row."""
    texts = plain(df, {"id": id_col, "text": text_col}).select("id", normalized().alias("norm"))
    block_names, seed = _name_blocks(texts, block_chars)
    rows = materialize(texts.select("id", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
                                    _hashed("norm", block_chars, seed).alias("hashes")), "rows")
    classes = materialize(
        rows.groupBy("hashes").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    # sequences of one identity are one group
    named = materialize(classes.select("cid", "least", "rows").join(identities(classes, block_names), "cid"), "named")
    groups = named.groupBy("n", "name").agg(F.min("least").alias("keep_id"), F.sum("rows").alias("group_size"))
    ident = (named.join(groups, ["n", "name"]).join(classes.select("cid", "hashes"), "cid")
             .select("hashes", "keep_id", "group_size", F.concat_ws(":", "n", "name").alias("identity")))
    counted = rows.groupBy("id", "sha", "hashes").agg(F.count("*").alias("copies"))
    return (counted.join(ident, "hashes")
            .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256"), "identity"))


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("identity")


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
