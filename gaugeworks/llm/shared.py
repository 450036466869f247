"""Small pieces that several operators use: the shared folder, checkpoints, CRC split, stable batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: blank, and tab to carriage return.
GAP = r"[\x20\x09-\x0D]"
NOT_GAP = r"[^\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one under /tmp in local tests."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that its machines share")
        at = f"file:///tmp/gaugeworks-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_frequency(rows: DataFrame, table: DataFrame, key: str, count: str = "n", parts: int = 1000) -> DataFrame:
    """rows joined with a written table of distinct keys and the number of rows of each (`count`).

    The `parts` most frequent keys are joined by broadcast where their rows are, the others are shuffled; none of
    these has more than one row in `parts`. So one key may hold any share of the rows.
    """
    hot = F.broadcast(table.orderBy(F.desc(count), key).limit(parts))  # `parts` keys
    rest = rows.join(hot.select(key), key, "left_anti").join(table, key)
    return rows.join(hot, key).unionByName(rest)


def salted(rows: DataFrame, table: DataFrame, key: str, counted: DataFrame | None = None, parts: int = 1000, copies: int = 32) -> DataFrame:
    """rows joined with a table on a key that may be any share of the rows, where a key may have several or wide rows in the table.

    The `parts` most frequent keys, as far as they have enough rows for it, are dealt to `copies` tasks, and their
    rows of the table are copied to these; none of the others has more than one row in `parts`. counted: a frame
    with the key's column to count in, if not rows.
    """
    n = (rows if counted is None else counted).groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") >= 2 * copies)
    hot = F.broadcast(n.orderBy(F.desc("__n"), key).limit(parts).select(key, F.lit(True).alias("__hot")))  # `parts` keys
    dealt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(copies))).otherwise(0).cast("int")
    left = rows.join(hot, key, "left").withColumn("__salt", dealt).drop("__hot")
    copied = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(hot, key, "left").withColumn("__salt", F.explode(copied)).drop("__hot")
    return left.join(right, [key, "__salt"]).drop("__salt")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold_of(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def small_batches(batches: Iterator[pa.RecordBatch], text_col: int = 1, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `limit` bytes of text (one long text may be more)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)
