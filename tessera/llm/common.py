"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# rows of one Arrow batch that an operator turns into Python objects at a time
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage.

    ``spark.checkpoint.dir`` where the cluster names one. Only a session
    whose master is local gets a folder of its own when that is unset.
    """
    root = checkpoint_dir(spark)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; executors need a shared folder")
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="tessera-checkpoints-"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The written table has no lineage: an executor that is lost later costs
    only the tasks that it was running.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tessera-llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plain(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns ``{internal name: input name}`` alone, under internal names.

    Operators work on this projection, so further input columns, whatever
    their names, neither reach the shuffle nor clash with working columns.
    """
    return df.select(*[F.col(f"`{given}`").alias(own) for own, given in columns.items()])


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that only a few hundred texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def keep_rows(df: DataFrame, text_col: str, decide: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """Rows of ``df`` whose text ``decide()`` keeps; columns and schema stay.

    One pass without a shuffle: ``decide`` is called once per task and its
    result once per slice of texts.
    """
    at = df.columns.index(text_col)

    def run(batches):
        judge = decide()
        for b in slices(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(judge(texts), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def keep_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in ``ids`` (null equals null); columns stay.

    Both sides are hashed by id; the narrow id side is the build side, so
    the texts are shuffled once and never sorted.
    """
    other = ids.select(F.col(id_col).alias("__keep_id")).distinct().hint("shuffle_hash")
    return df.join(other, df[f"`{id_col}`"].eqNullSafe(F.col("__keep_id")), "left_semi")


def keep_decided(df: DataFrame, decisions: DataFrame, key: Column, id_col: str = "doc_id",
                 key_col: str = "text_sha256") -> DataFrame:
    """Rows of ``df`` that ``decisions`` (id, key, kept) keeps; columns stay.

    Ids are unique in a sound table, and then decide alone. Rows that share
    an id are told apart by ``key``, an expression over ``df`` that equals
    the decisions' ``key_col``; of those that share both, one stays.
    """
    counted = materialize(
        decisions.groupBy(id_col).agg(F.count("*").alias("rows"), F.max("kept").alias("kept")), "decisions")
    once = keep_ids(df, counted.where("rows = 1 and kept"), id_col)
    if counted.where("rows > 1").isEmpty():
        return once
    again = keep_ids(df, counted.where("rows > 1 and kept"), id_col)
    wanted = decisions.where("kept").select(F.col(id_col).alias("__id"), F.col(key_col).alias("__wanted")).distinct()
    again = again.withColumn("__key", key)
    again = again.join(wanted, again[f"`{id_col}`"].eqNullSafe(wanted["__id"])
                       & (again["__key"] == wanted["__wanted"]), "left_semi")
    one = again.groupBy(f"`{id_col}`", "__key").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__row"))
    return once.unionByName(one.select(*[F.col("__row").getField(c).alias(c) for c in df.columns]))
