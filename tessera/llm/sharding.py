"""Sharding by jump consistent hashing, with gapless slots inside a shard.

A row's shard follows from its key and the shard count alone (law ``key``):
the 64-bit hash of the key seeds a linear congruential generator whose
draws decide how far the key jumps ahead; the last jump below the shard
count is its shard. With one more shard a key either stays or goes to the
new shard, which the same jumps tell.

Slots number the rows of a shard from 0. Rows are counted in buckets of a
shard, the bounded table of bucket counts is summed up to offsets, and rows
are numbered inside their bucket, so no task sees a whole shard. Identical
rows are counted before the shuffle and get a run of slots.

Defined cases: a null text has size 1 and the checksum of the empty text; a
null id is a key like any other; repeated rows all come back, each with its
own slot; texts of any length are measured whole; further columns are left out,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import plain, read_table, text_or_empty

SHARDS = 16
# rows of the offset table (shards times buckets), which is broadcast: 24 bytes each
OFFSET_ROWS = 65_536

_LCG = 2862933555777941757
_M32, _M16 = 0xFFFFFFFF, 0xFFFF


def jump_shards(key: Column, shards: int) -> tuple[Column, Column]:
    """Shard of ``key`` (a long) among ``shards``, and among ``shards + 1``.

    The generator's product is taken in 32- and 16-bit parts, which stay
    below 2^63, as ANSI arithmetic refuses the wrap-around.
    """
    c1, c0 = _LCG >> 32, _LCG & _M32
    c01, c00 = c0 >> 16, c0 & _M16

    def let(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def step(s: Column) -> Column:
        a1, a0 = s["hi"], s["lo"]

        def with_low(v: Column) -> Column:
            # v.p1: the middle product, v.lo: the low sum with its carry
            mid = a1 * F.lit(c01)
            hi = (F.shiftrightunsigned(v["sum"], 32) + F.shiftrightunsigned(v["p1"], 16)
                  + (a0 * F.lit(c1)).bitwiseAND(F.lit(_M32)) + a1 * F.lit(c00)
                  + F.shiftleft(mid.bitwiseAND(F.lit(_M16)), 16)).bitwiseAND(F.lit(_M32))
            return let(hi, lambda h: F.struct(
                s["j"].alias("b"),
                F.floor((s["j"] + 1).cast("double")
                        * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(h, 1) + 1).cast("double"))).alias("j"),
                h.alias("hi"), v["sum"].bitwiseAND(F.lit(_M32)).alias("lo")))

        p1 = a0 * F.lit(c01)
        return let(F.struct(p1.alias("p1"),
                            (a0 * F.lit(c00) + F.shiftleft(p1.bitwiseAND(F.lit(_M16)), 16) + 1).alias("sum")),
                   with_low)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_M32)).alias("lo"))
    # each jump goes ahead by one at least, so that many rounds always do
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start,
                      lambda s, _: F.when(s["j"] < shards, step(s)).otherwise(s))
    return end["b"], F.when(end["j"] == shards, F.lit(shards).cast("long")).otherwise(end["b"])


def shard_rows(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    body = text_or_empty().cast("binary")
    rows = (plain(df, {"id": id_col, "text": text_col})
            .select("id", (F.octet_length(body).cast("long") + 1).alias("size"),
                    F.crc32(body).alias("crc"))
            .groupBy("id", "size", "crc").agg(F.count("*").alias("copies")))
    shard, grown = jump_shards(F.xxhash64("id"), shards)
    per_shard = max(1, OFFSET_ROWS // shards)
    rows = (rows.withColumn("jump", F.struct(shard.alias("s"), grown.alias("g")))
            .select("id", "size", "crc", "copies", F.col("jump.s").cast("int").alias("shard"),
                    F.col("jump.g").cast("int").alias("grown"),
                    F.pmod(F.xxhash64("crc", "id", "size"), F.lit(per_shard)).cast("int").alias("bucket")))
    within = Window.partitionBy("shard", "bucket").orderBy("id", "size", "crc")
    placed = rows.withColumn("before", F.sum("copies").over(within) - F.col("copies"))
    ahead = Window.partitionBy("shard").orderBy("bucket")
    offsets = (rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
               .select("shard", "bucket", (F.sum("n").over(ahead) - F.col("n")).alias("offset")))
    if shards * per_shard <= OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    return (placed.join(offsets, ["shard", "bucket"])
            .withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("before") + F.col("copy")).alias("slot"),
                    F.col("grown").alias("grown_shard")))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_rows(read_table(spark, sf_dir, "documents"))
