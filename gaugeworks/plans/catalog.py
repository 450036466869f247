"""The graph of tables read from a database's own catalog.

Metadata come as DataFrames in the form of the SQL standard's information schema, over JDBC or from anywhere else:

table_constraints: constraint_schema, constraint_name, table_schema, table_name, constraint_type;
key_column_usage: constraint_schema, constraint_name, table_schema, table_name, column_name, ordinal_position,
position_in_unique_constraint; referential_constraints: constraint_schema, constraint_name,
unique_constraint_schema, unique_constraint_name; tables: table_schema, table_name.

Only keys and links of one column count. A catalog has a row for each table and constraint, so what is read to the
driver grows with the schema, not with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.flat import read_database
from .traversal import ForeignKey, Graph

SYSTEM = ("information_schema", "pg_catalog")
_NAME = ["constraint_schema", "constraint_name"]
VIEWS = ("tables", "table_constraints", "key_column_usage", "referential_constraints")


def read_catalog(spark: SparkSession, url: str, **more: str) -> dict[str, DataFrame]:
    """The views of a database's information schema."""
    return {v: read_database(spark, url, f"SELECT * FROM information_schema.{v}", **more) for v in VIEWS}


def _single(constraints: DataFrame, usage: DataFrame, kind: str) -> DataFrame:
    """The column of each constraint of a kind that has one column alone: (constraint, table_schema, table_name, column_name, position)."""
    own = constraints.filter(F.upper("constraint_type") == kind).filter(~F.col("table_schema").isin(*SYSTEM)).select(*_NAME)
    columns = usage.join(own, _NAME)
    return columns.groupBy(*_NAME, "table_schema", "table_name").agg(F.min("column_name").alias("column_name"), F.min("position_in_unique_constraint").alias("position"), F.count("*").alias("n")).filter("n = 1").drop("n")


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """(table_schema, table_name, column_name) of tables with a key of one column."""
    return _single(constraints, usage, "PRIMARY KEY").select("table_schema", "table_name", "column_name")


def foreign_keys(constraints: DataFrame, usage: DataFrame, references: DataFrame) -> DataFrame:
    """(table_schema, table_name, column_name, target_schema, target_name, target_column) of links of one column."""
    own = _single(constraints, usage, "FOREIGN KEY").join(references.select(*_NAME, "unique_constraint_schema", "unique_constraint_name"), _NAME)
    to = usage.select(
        F.col("constraint_schema").alias("unique_constraint_schema"), F.col("constraint_name").alias("unique_constraint_name"), F.col("ordinal_position").alias("position"),
        F.col("table_schema").alias("target_schema"), F.col("table_name").alias("target_name"), F.col("column_name").alias("target_column"),
    )
    met = own.withColumn("position", F.coalesce("position", F.lit(1))).join(to, ["unique_constraint_schema", "unique_constraint_name", "position"])
    return met.select("table_schema", "table_name", "column_name", "target_schema", "target_name", "target_column")


def reference_tables(tables: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    """Those of the wanted tables that there are, in order."""
    there = tables.filter(~F.col("table_schema").isin(*SYSTEM)).filter(F.col("table_name").isin(*wanted) if wanted else F.lit(False))
    return [r.table_name for r in there.select("table_name").distinct().orderBy("table_name").collect()]


def graph(catalog: dict[str, DataFrame], reference: tuple[str, ...] = (), schema: str = "public", system: tuple[str, ...] = ()) -> Graph:
    """A schema's tables, their keys and links; reference: tables that are joined, not walked, as far as they are there."""
    tables, constraints, usage = (catalog[v] for v in VIEWS[:3])
    own = F.col("table_schema") == schema
    keys = tables.filter(own).select("table_name").distinct().join(primary_keys(constraints, usage).filter(own).select("table_name", "column_name"), "table_name", "left")
    links = foreign_keys(constraints, usage, catalog["referential_constraints"]).filter(own & (F.col("target_schema") == schema)).orderBy("table_name", "column_name", "target_name")
    found = tuple(ForeignKey(r.table_name, r.column_name, r.target_name, r.target_column) for r in links.collect())
    return Graph({r.table_name: r.column_name for r in keys.orderBy("table_name").collect()}, found, frozenset(system), frozenset(reference_tables(tables, reference)))
