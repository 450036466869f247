"""Tables for review: what a reconciliation found, one row for each thing to look at, with a mark for its weight."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weight(pct: Column) -> Column:
    """How much a difference of capacities matters: 'dark' from 5 % on, or where there is nothing to compare with."""
    return F.when(pct.isNull() | (pct >= 5), "dark").otherwise("light")


def operating_table(matches: DataFrame, unit_matches: DataFrame) -> DataFrame:
    """A row for each match and, below it, one for each of its units: (match, level, site, register_unit, report_capacity, register_capacity, delta, fill).

    matches: match, site, vessel, report_capacity, register_capacity, disagrees; unit_matches: match, site,
    register_unit, report_capacity, register_capacity, agrees. A vessel is shown with its site, unless that has a bracket.
    """
    delta = F.bround(F.col("report_capacity") - F.col("register_capacity"), 2)
    pct = F.when(F.col("register_capacity") != 0, F.abs(F.col("report_capacity") - F.col("register_capacity")) / F.col("register_capacity") * 100)
    shown = F.when((F.coalesce("vessel", F.lit("")) != "") & ~F.col("site").contains("("), F.concat(F.col("site"), F.lit(" ("), F.col("vessel"), F.lit(")"))).otherwise(F.col("site"))
    both = lambda level, site, unit, bad: ("match", F.lit(level).alias("level"), site.alias("site"), unit.alias("register_unit"), "report_capacity", "register_capacity", delta.alias("delta"), F.when(bad & (delta != 0), weight(pct)).otherwise("").alias("fill"))
    top = matches.select(*both("project", shown, F.lit("").cast("string"), F.col("disagrees")))
    return top.unionByName(unit_matches.select(*both("unit", F.col("site"), F.col("register_unit"), ~F.col("agrees"))))


def nonoperating_table(units: DataFrame) -> DataFrame:
    """units (country, terminal, unit_name, status, capacity, mention) with register_only, whether the report doesn't mention them, by country, terminal, status and unit."""
    told = units.withColumn("register_only", F.when(F.coalesce("mention", F.lit("")) == "", "only in the register").otherwise(""))
    return told.orderBy(*[F.col(c).asc_nulls_first() for c in ("country", "terminal", "status", "unit_name") if c in told.columns])


def staged_table(rows: DataFrame, columns: list[str], read_only: tuple[str, ...] = ()) -> DataFrame:
    """A flat sheet of staged rows: the sheet's columns in order, without those that a register computes itself; what the rows lack is null, what they have besides goes."""
    return rows.select(*[F.col(f"`{c}`").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns if c not in read_only])


def stale_table(flagged: DataFrame, flags: str = "flags") -> DataFrame:
    """A row for each flag of a unit, with a fill for those that matter."""
    each = flagged.select(*[c for c in flagged.columns if c != flags], F.explode(flags).alias("__f")).select("*", "__f.flag", "__f.severity").drop("__f")
    return each.withColumn("fill", F.when(F.col("severity").isin("high", "medium"), "yellow").otherwise(""))


#: The parts of a list of actions, in their order, with what to do.
ACTIONS = {
    "report_only": "discovery: look for it under another name",
    "register_only": "update: verify the status",
    "ambiguous": "choose among the candidates by hand",
    "disagreement": "update: look into the difference",
    "narrative": "update: check the cited source",
}


def action_list(parts: dict[str, DataFrame]) -> DataFrame:
    """(part, action, country, site, note, todo): the parts, each with (country, site, note), one after the other by part, country and site."""
    out = [df.select(F.lit(i).alias("part"), F.lit(name).alias("action"), "country", "site", "note", F.lit(todo).alias("todo")) for i, (name, todo) in enumerate(ACTIONS.items()) if (df := parts.get(name)) is not None]
    return reduce(DataFrame.unionByName, out)


def candidate_edits(units: DataFrame, findings: DataFrame, key: str = "terminal_id") -> DataFrame:
    """Units of the terminals that were found, with kind, the first finding's (by rank), and summary, all findings in order.

    findings: key, rank, kind, text. A terminal's findings are put together before they meet its units.
    """
    told = F.concat(F.col("kind"), F.lit(": "), F.col("text"))
    own = findings.groupBy(key).agg(F.min_by("kind", "rank").alias("kind"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", told.alias("told")))), lambda x: x.told), "; ").alias("summary"))
    return units.join(own, key)
