"""Flat exports and staged lists: reading with a header contract, writing packages of sheets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a spreadsheet shows for a failed formula.
FORMULA_ERRORS = ("#REF!", "#DIV/0!", "#VALUE!", "#NAME?", "#NULL!", "#NUM!", "#N/A")


@dataclass(frozen=True)
class Header:
    """How a file's header meets a contract of (canonical name -> header)."""

    found: dict[str, str]
    missing: list[str]
    unknown: list[str]


#: Spark's own setting: shuffle files go when the execution that made them ends, not when the driver happens to collect its garbage.
SHORT_LIVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHORT_LIVED, "false")
    spark.conf.set(SHORT_LIVED, "true")
    try:
        yield
    finally:
        spark.conf.set(SHORT_LIVED, before)


def _step(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder; in a folder under /tmp only where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir, a folder that its machines share")
        folder = f"file:///tmp/gaugeworks-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/step-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written once to the shared checkpoint folder and read back. Nothing runs df itself again, so the shuffle files of the write go with it."""
    spark, path = df.sparkSession, _step(df.sparkSession)
    with _shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, deal: bool = True) -> DataFrame:
    """df as `checkpointed` gives it, in buckets by a key: what joins or groups it by that key does not deal its rows again.

    deal: whether its rows must be dealt by the key first; rows that were just grouped or joined by it need not be.
    """
    spark, path, name = df.sparkSession, _step(df.sparkSession), f"step_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = [f"c{i}" for i in range(len(df.columns))]  # any name will do for a column of df
    own = df.repartition(n, F.col(f"`{key}`")) if deal else df
    with _shuffles_end(spark):
        own.toDF(*place).write.option("path", path).option("compression", "zstd").bucketBy(n, place[df.columns.index(key)]).saveAsTable(name)
    out = spark.table(name).toDF(*df.columns)
    spark.sql(f"DROP TABLE {name}")  # the name alone: files of a table with a path of its own stay
    return out


def match_header(columns: list[str], contract: dict[str, str]) -> Header:
    """Exact match after trimming; a byte-order mark before the first name is no part of it."""
    own = {c.strip().removeprefix("﻿"): c for c in columns}
    found = {name: own[head] for name, head in contract.items() if head in own}
    return Header(found, [n for n in contract if n not in found], [h for h in own if h not in contract.values()])


def read_flat(spark: SparkSession, path: str, contract: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    """A flat export under canonical names, all text, '' as null; rows shorter than the header go, missing columns are null."""
    header = spark.read.text(path).limit(1).collect()
    names = next(iter(_split_header(header[0][0]))) if header else []
    schema = T.StructType([T.StructField(n or f"_{i}", T.StringType()) for i, n in enumerate(names)] + [T.StructField("_short", T.StringType())])
    rows = spark.read.csv(path, schema=schema, header=True, enforceSchema=True, quote='"', escape='"', multiLine=True, nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord="_short")
    head = match_header(names, contract)
    return rows.filter("_short IS NULL").select(*[F.col(f"`{head.found[n]}`").alias(n) if n in head.found else F.lit(None).cast("string").alias(n) for n in (*contract, *extra)])


def _split_header(line: str) -> list[list[str]]:
    import csv
    import io

    return list(csv.reader(io.StringIO(line))) or [[]]


def first_of(df: DataFrame, *names: str) -> Column:
    """The first non-empty of those columns that a tolerant file may have."""
    return F.coalesce(*[F.when(F.trim(F.col(f"`{n}`")) != "", F.col(f"`{n}`")) for n in names if n in df.columns], F.lit(None).cast("string"))


def read_json_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A staged JSON list, or no rows if the file is not there or is not whole JSON of that form: a part of a broken list is never taken for the list."""
    none = spark.createDataFrame([], schema)
    try:
        read = spark.read.schema(f"{schema}, _broken string").json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
    except AnalysisException:
        return none
    first = none.columns[0]  # a scan of the mark alone is not allowed
    broken = read.agg(F.count_if(F.col("_broken").isNotNull()), F.count(F.col(f"`{first}`"))).first()[0]
    return none if broken else read.drop("_broken")


def list_tables(spark: SparkSession, database: str | None = None, system: tuple[str, ...] = ("information_schema", "pg_catalog")) -> list[str]:
    """Names of the tables of a database, in order, without system ones and temporary views."""
    if database in system:
        return []
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def describe(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) of every column, in order."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


def table_name(text: str, schema: str = "public") -> tuple[str, str]:
    """'a.b' as (a, b), 'b' as (public, b)."""
    first, dot, rest = text.strip().partition(".")
    return (first, rest) if dot else (schema, first)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document a row; nulls are kept as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_database(spark: SparkSession, url: str, query: str, timeout_s: int = 300, fetch: int = 1000, **more: str) -> DataFrame:
    """A read-only query through JDBC, with a time limit and fetch size."""
    options = {"url": url, "query": query, "queryTimeout": str(timeout_s), "fetchsize": str(fetch), "sessionInitStatement": "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY"} | more
    return spark.read.format("jdbc").options(**options).load()


def read_page_texts(spark: SparkSession, path: str, marker: str | None = None, within: int = 400) -> DataFrame:
    """(file, page, text) of extracted texts whose pages are parted by form feeds; only pages that begin with a marker, if one is given."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\f")).alias("page", "text"))
    return whole if marker is None else whole.filter(F.substring("text", 1, within).contains(marker))


def write_flat(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None, mark: bool = False) -> int:
    """A flat export: null as '', rows in order; gives the number of rows, counted as they are written.

    columns: the export's columns in order, whatever df has; those it lacks are empty. mark: begin files with a byte-order mark.
    """
    names = list(columns or df.columns)
    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")
    head = ["\ufeff" + n if mark and not i else n for i, n in enumerate(names)]
    seen = Observation()
    ordered = df.orderBy(*order).select(*[cell(n).alias(h) for n, h in zip(names, head, strict=True)])
    ordered.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
    return seen.get["rows"]


def write_package(sheets: dict[str, DataFrame], path: str, read_only: tuple[str, ...] = ()) -> list[tuple[str, int, str]]:
    """One folder a sheet, without read-only columns; gives (sheet, columns, error), and goes on after a sheet that fails."""
    out = []
    for name, df in sheets.items():
        own = df.drop(*read_only)
        try:
            own.write.mode("overwrite").parquet(f"{path}/{name}")
            out.append((name, len(own.columns), ""))
        except Exception as error:  # noqa: BLE001  recorded in the manifest
            out.append((name, len(own.columns), str(error).splitlines()[0]))
    return out


def sheet_errors(df: DataFrame, key: str) -> DataFrame:
    """(key, field, value, kind) of cells that show a formula's error or a formula itself."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns if c != key])
    each = df.select(F.col(key), F.explode(cells).alias("x")).select(key, "x.*")
    kind = F.when(F.col("value").isin(*FORMULA_ERRORS), "error").when(F.col("value").startswith("=") & (F.length("value") > 1), "formula")
    return each.withColumn("kind", kind).filter("kind IS NOT NULL")
