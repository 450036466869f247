"""Latest status of each unit over an append-only log of status entries (an extension: the batch form is functions.lifecycle.current)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(entries: DataFrame, late: str = "1 day") -> DataFrame:
    """(unit_id, status, ts) of the last real entry of each unit; entries (unit_id, ts, status, substatus), batch or stream.

    On a stream, run it in update mode: state is one row a unit. The watermark only drops entries that come later than `late`.
    """
    real = entries.filter("lower(coalesce(substatus, '')) <> 'planned' AND lower(coalesce(status, '')) <> 'fid'")
    if entries.isStreaming:
        real = real.withWatermark("ts", late)
    return real.groupBy("unit_id").agg(F.max_by("status", "ts").alias("status"), F.max("ts").alias("ts"))


def windowed_counts(entries: DataFrame, width: str = "7 days", late: str = "1 day") -> DataFrame:
    """(window start, status, n): entries by event-time window; closed windows leave the state."""
    own = entries.withWatermark("ts", late) if entries.isStreaming else entries
    return own.groupBy(F.window("ts", width).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")
