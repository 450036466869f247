"""Exports of a root table and all that hangs on it: a walk over foreign keys, each table a chain of semi-joins.

The walk is over metadata and runs on the driver; the rows are Spark's. A table is reached once, through the
first parent that reaches it, and only by foreign keys to that parent's key.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MAX_DEPTH = 3


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    target: str
    target_column: str


@dataclass(frozen=True)
class Step:
    """How a table is reached: by `column` to its parent's key."""

    table: str
    depth: int
    column: str | None = None
    parent: Step | None = None
    key: str | None = None


@dataclass(frozen=True)
class Graph:
    keys: dict[str, str | None]
    links: tuple[ForeignKey, ...]
    system: frozenset[str] = field(default_factory=frozenset)
    reference: frozenset[str] = field(default_factory=frozenset)

    def walk(self, root: str, depth: int = MAX_DEPTH, without: frozenset[str] = frozenset()) -> list[Step]:
        """Breadth first from the root, without system, reference and named tables; a table without key is a leaf."""
        if not self.keys.get(root):
            raise ValueError(f"{root} has no single-column key")
        skip = self.system | self.reference | without
        front = [Step(root, 0, key=self.keys[root])]
        steps, seen = list(front), {root}
        for level in range(1, depth + 1):
            front_next = []
            for parent in front:
                for link in sorted((x for x in self.links if x.target == parent.table and parent.key and x.target_column == parent.key), key=lambda x: (x.table, x.column)):
                    if link.table not in seen and link.table not in skip:
                        seen.add(link.table)
                        front_next.append(Step(link.table, level, link.column, parent, self.keys.get(link.table)))
            steps += front_next
            front = front_next
        return steps


def export(step: Step, tables: dict[str, DataFrame], root_filter: str, limit: int | None = None) -> DataFrame:
    """The rows of a step's table that hang on the filtered root."""

    def rows(at: Step) -> DataFrame:
        own = tables[at.table]
        if at.parent is None:
            return own.filter(root_filter)
        above = rows(at.parent).select(F.col(at.parent.key).alias("__key"))
        return own.join(above, F.col(at.column) == F.col("__key"), "left_semi")

    out = rows(step)
    return out.limit(limit) if limit else out


def manifest_entry(step: Step, rows: int | None, error: str = "") -> tuple[str, int, str, int | None, str]:
    return step.table, step.depth, "root" if step.parent is None else "fk", rows, error


def file_name(label: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", label)


def read_only(sql: str) -> str:
    """The query, if it only reads; brackets before it do no harm."""
    if not sql.strip().lstrip("(").strip().lower().startswith(("select", "with")):
        raise ValueError("only SELECT and WITH queries may run")
    return sql


MANIFEST = "table string, depth int, mode string, rows long, file string, error string"


def write_manifest(spark: SparkSession, entries: list[tuple[str, int, str, int | None, str]], folder: str) -> DataFrame:
    """The manifest of an export as a written CSV table, `_manifest`: a row for each table, with its folder and what went wrong."""
    rows = [(table, depth, mode, n, "" if error else file_name(table), error) for table, depth, mode, n, error in entries]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").csv(f"{folder}/_manifest", header=True)
    return spark.read.schema(MANIFEST).csv(f"{folder}/_manifest", header=True)


def project_type(value: str, types: dict[str, str]) -> tuple[str, str]:
    """(code, warning) of a project type given by name, in any case, or by its code of digits; an unknown code is taken with a warning, an unknown name is an error."""
    text = value.strip()
    if text.isdigit():
        return text, "" if text in types.values() else f"unknown code {text}"
    found = {name.lower(): code for name, code in types.items()}.get(text.lower())
    if found is None:
        raise ValueError(f"unknown project type {value!r}; known: {', '.join(sorted(types))}")
    return found, ""


def export_all(steps: list[Step], tables: dict[str, DataFrame], root_filter: str, folder: str, limit: int | None = None) -> list[tuple[str, int, str, int | None, str]]:
    """Writes the rows of every step as Parquet, one folder a table, counted as they are written, and the manifest. A table that fails is recorded there, and the others go on."""
    out = []
    for step in steps:
        path = f"{folder}/{file_name(step.table)}"
        try:
            seen = Observation()
            export(step, tables, root_filter, limit).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            out.append(manifest_entry(step, seen.get["rows"]))
        except Exception as error:  # noqa: BLE001  recorded in the manifest
            out.append(manifest_entry(step, None, str(error).splitlines()[0]))
    spark = next(iter(tables.values())).sparkSession
    write_manifest(spark, out, folder)
    return out
