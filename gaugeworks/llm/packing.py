"""Best-fit packing of documents into sequences by large-item matching.

Only documents longer than a sequence are cut: into whole sequences from the end, so that the first piece
takes the rest. Pieces above a third of the capacity are large: at most two fit one bin. They are matched
greedily, each with the longest large piece that still fits, from the longest down. Smaller pieces then
go, from the longest down, into the bin with the smallest gap that takes them.

Lengths are whole numbers up to the capacity, so the plan needs only how many pieces each length has: a
table of `capacity` rows at most, whatever the corpus. The plan places runs of equal pieces into runs of
bins; a piece finds its place by its number among the pieces of its length. That number comes from
counts by (length, salt) and a row number inside each, so one length may hold most of all pieces.

Null text is the empty text (the end id alone). Very long texts are encoded whole and cut into as many pieces as they
need. Ties: pieces of one length are numbered by salt, id and piece; which of them gets a place does not matter. Repeated rows are packed one by one. A null id stays
null in the result. Empty tables give an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encoder import chunk_encoder
from .shared import small_batches, written

Run = tuple[int, int, int, int, int]  # length, first number, pieces, first bin, offset


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs of pieces of one length in runs of bins, and the number of bins."""
    left = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = defaultdict(int)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of bins (first, bins)
    bins = 0

    def place(length: int, pieces: int, first: int, offset: int) -> None:
        runs.append((length, used[length], pieces, first, offset))
        used[length] += pieces
        left[length] -= pieces

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            k = bisect.bisect_right(large, min(capacity - n, n)) - 1
            while k >= 0 and not left[large[k]]:
                k -= 1
            mate = large[k] if k >= 0 else 0
            if mate == n and left[n] == 1:
                while k >= 0 and (large[k] == n or not left[large[k]]):
                    k -= 1
                mate = large[k] if k >= 0 else 0
            pairs = left[n] if not mate else left[n] // 2 if mate == n else min(left[n], left[mate])
            place(n, pairs, bins, 0)
            if mate:
                place(mate, pairs, bins, n)
            gap = capacity - n - mate
            if gap:
                gaps[gap].append((bins, pairs))
            bins += pairs
    order = sorted(gaps)
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            k = bisect.bisect_left(order, n)
            if k == len(order):
                per = capacity // n  # a new bin takes as many of this length as fit
                fresh = -(-left[n] // per)
                gaps[capacity].append((bins, fresh))
                bisect.insort(order, capacity)
                bins += fresh
                continue
            gap = order[k]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(k)
            take = min(many, left[n])
            place(n, take, first, capacity - gap)
            for rest, at, number in ((gap - n, first, take), (gap, first + take, many - take)):
                if number and rest:
                    if rest not in gaps:
                        bisect.insort(order, rest)
                    gaps[rest].append((at, number))
    return runs, bins


def pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece of every document."""
    end = int(end_id).to_bytes(4, "little")
    kinds = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        for batch in small_batches(batches):
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                at, size = 0, n % capacity or capacity
                for k in range(-(-n // capacity)):
                    own = ids[4 * at : 4 * (at + size)]
                    rows.append((key, k, at, size, zlib.crc32(own), *([np.frombuffer(own, "<u4").astype(np.int32)] if with_ids else [])))
                    at, size = at + size, capacity
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names[: len(columns)])

    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(cut, kinds).withColumnRenamed("id", id_col)


def assign(cut: DataFrame, capacity: int, id_col: str = "doc_id", rows_per_group: int = 2_000) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces that can be read more than once (a written one)."""
    spark = cut.sparkSession
    total = cut.count()
    salts = max(1, -(-total // rows_per_group))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece", "start", "ids_crc32"), F.lit(salts)))
    # at most capacity rows of counts by length for the plan; those by length and salt stay in Spark
    counted = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    by_length = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(by_length, capacity)
    before = counted.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy(id_col, "piece", "start", "ids_crc32"))
    numbered = salted.withColumn("own", number).join(before, ["length", "salt"]).withColumn("number", F.col("before") + F.col("own") - 1).drop("salt", "own", "before")
    place = spark.sparkContext.broadcast(_Places(runs))  # bounded by the plan: capacity squared at the very worst, some thousand runs as a rule

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, offset = place.value.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "number"]
            names = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at), pa.array(offset)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in numbered.dtypes if n != "number")
    return numbered.mapInArrow(put, f"{kinds}, sequence_id long, offset long").select(*cut.columns, "sequence_id", "offset")


class _Places:
    """The plan's runs, ordered for binary search by length and number."""

    def __init__(self, runs: list[Run]):
        rows = np.array(sorted(runs), np.int64).reshape(-1, 5)
        self.key = (rows[:, 0] << 44) | rows[:, 1]
        self.rows = rows

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.rows[np.searchsorted(self.key, (length << 44) | number, "right") - 1]
        return row[:, 3] + number - row[:, 1], row[:, 4]


def pack(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every document."""
    return assign(written(pieces(df, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces"), capacity, id_col)
