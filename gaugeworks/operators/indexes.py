"""Indexes over a flat table of units: by site, by sponsor, by name; vessels against another list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from .relational import containments

_ROW = ["terminal_id", "unit_id", "terminal_name", "unit_name", "owner", "status"]


def site_index(units: DataFrame) -> DataFrame:
    """(country_norm, name_norm, n_units, n_terminals, rows) by normal country and site name."""
    own = units.withColumns({"country_norm": names.country(F.col("country")), "name_norm": names.site(F.col("terminal_name"))}).filter("country_norm <> '' AND name_norm <> ''")
    return own.groupBy("country_norm", "name_norm").agg(F.count("*").alias("n_units"), F.count_distinct("terminal_id").alias("n_terminals"), F.sort_array(F.collect_list(F.struct("unit_id", "terminal_id"))).alias("rows"))


def sponsor_index(units: DataFrame) -> DataFrame:
    """(country_norm, sponsor, n_units, n_terminals): owners cut at commas."""
    cells = units.select("owner").distinct().withColumn("part", F.explode(F.array_distinct(names.owner_parts(F.col("owner")))))
    parts = units.withColumn("country_norm", names.country(F.col("country"))).select("country_norm", "terminal_id", F.explode(names.owner_parts(F.col("owner"))).alias("part"))
    each = parts.join(names.entities(cells, "part"), "part").withColumnRenamed("entity", "sponsor").filter("country_norm <> '' AND sponsor <> ''")
    return each.groupBy("country_norm", "sponsor").agg(F.count("*").alias("n_units"), F.count_distinct("terminal_id").alias("n_terminals"))


def unit_index(units: DataFrame, order: str = "row") -> DataFrame:
    """One row a unit_id: of several the last by `order`, as a whole, and of such with one order the row that compares greatest. Rows without an id make none."""
    rows = units.filter("unit_id <> ''").select("unit_id", F.struct(*[c for c in units.columns if c != "unit_id"]).alias("own"), F.col(order).alias("at"))
    last = rows.groupBy("unit_id").agg(F.max_by("own", F.struct("at", "own")).alias("own"))
    return last.select("unit_id", "own.*")


def index_stats(units: DataFrame) -> DataFrame:
    """One row of counts: n_rows, n_terminals, project_keys, sponsor_keys, unit_keys, multi_unit_projects. Each index is aggregated apart; their one-row counts meet at the end."""
    all_rows = units.agg(F.count("*").alias("n_rows"), F.count_distinct("terminal_id").alias("n_terminals"), F.count_distinct(F.when(F.col("unit_id") != "", F.col("unit_id"))).alias("unit_keys"))
    sites = site_index(units).agg(F.count("*").alias("project_keys"), F.count(F.when(F.col("n_units") > 1, 1)).alias("multi_unit_projects"))
    sponsors = sponsor_index(units).agg(F.count("*").alias("sponsor_keys"))
    one = lambda df: df.withColumn("__one", F.lit(1))
    out = one(all_rows).join(one(sites), "__one").join(one(sponsors), "__one")
    return out.select("n_rows", "n_terminals", "project_keys", "sponsor_keys", "unit_keys", "multi_unit_projects")


def top_sponsors(index: DataFrame, n: int = 10) -> DataFrame:
    return index.orderBy(F.desc("n_units"), "country_norm", "sponsor").limit(n)


def find_entity(units: DataFrame, name: str, fields: list[str], country: str | None = None, parent_id: str | None = None) -> DataFrame:
    """(field, variant, hits, n_terminals): where and how a company is named; with parent_id (a column) also parent_ids, those beside it where it is an owner."""
    own = units if country is None else units.filter(names.country(F.col("country")) == names.country(F.lit(country)))
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    parent = F.trim(F.coalesce(F.col(parent_id).cast("string"), F.lit(""))) if parent_id else F.lit("")
    each = own.select("terminal_id", parent.alias("parent"), F.explode(cells).alias("x")).select("terminal_id", "parent", "x.field", F.explode(names.owner_parts(F.col("x.value"))).alias("variant"))
    tag = each.sparkSession.range(1).select(names.entity(F.lit(name)).alias("entity"))
    hits = each.join(names.entities(each, "variant").join(tag, "entity", "left_semi"), "variant")
    told = [F.count("*").alias("hits"), F.count_distinct("terminal_id").alias("n_terminals")]
    if parent_id:
        told.append(F.array_sort(F.collect_set(F.when((F.col("field") == "owner") & (F.col("parent") != ""), F.col("parent")))).alias("parent_ids"))
    return hits.groupBy("field", "variant").agg(*told)


def match_vessels(units: DataFrame, vessels: DataFrame) -> DataFrame:
    """(unit_id, vessel_name, other_name, how): units' vessels in another list.

    how: exact; contained (one name holds the other, and only one such); ambiguous; missing; unnamed. Of
    several rows of one name the last (by `row`) counts. The containment join runs only on what has no
    exact match, name by name.
    """
    key = lambda c: F.trim(F.lower(F.coalesce(F.col(c), F.lit(""))))
    other = vessels.withColumn("other_norm", key("vessel_name")).filter("other_norm <> ''")
    last = Window.partitionBy("other_norm").orderBy(F.desc("row"))
    other = other.withColumn("__rn", F.row_number().over(last)).filter("__rn = 1").select("other_norm", F.col("vessel_name").alias("other_name"))
    own = units.withColumn("norm", key("vessel_name"))
    named = own.filter("norm <> ''")
    exact = named.join(other, F.col("norm") == F.col("other_norm")).select("unit_id", "vessel_name", "other_name", F.lit("exact").alias("how"))
    rest = named.join(other, F.col("norm") == F.col("other_norm"), "left_anti").select("unit_id", "vessel_name", "norm")
    # distinct names meet by the rarest stretch of the one that is inside the other, so that no name meets all others
    left = rest.select("norm").distinct()
    met = containments(left, other.select("other_norm", "other_name"), [], "norm", "other_norm")
    met = met.unionByName(containments(other.select("other_norm", "other_name"), left, [], "other_norm", "norm")).distinct()
    found = met.groupBy("norm").agg(F.count("*").alias("n"), F.min("other_name").alias("other_name"))
    hits = rest.join(found, "norm", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    how = F.when(F.col("n") == 1, "contained").when(F.col("n") == 0, "missing").otherwise("ambiguous")
    near = hits.select("unit_id", "vessel_name", F.when(F.col("n") == 1, F.col("other_name")).alias("other_name"), how.alias("how"))
    none = own.filter("norm = ''").select("unit_id", "vessel_name", F.lit(None).cast("string").alias("other_name"), F.lit("unnamed").alias("how"))
    return exact.unionByName(near).unionByName(none)


def unmatched_vessels(vessels: DataFrame, matched: DataFrame, kind: str = "vessel_type") -> DataFrame:
    """Vessels of the other list that take part in regasification and that no unit names."""
    return vessels.filter(F.lower(F.coalesce(F.col(kind), F.lit(""))).rlike("fsru|regas|import")).join(matched.select(F.col("other_name").alias("vessel_name")), "vessel_name", "left_anti")


def flag_counts(flagged: DataFrame, country: str = "country", flags: str = "flags") -> DataFrame:
    """(level, country, flag, n, place): flags by flag, by country and flag and by country, in one pass of grouping sets; place: among countries by all their flags, ties by name."""
    each = flagged.select(F.coalesce(F.col(country), F.lit("")).alias("country"), F.explode(flags).alias("f")).select("country", F.col("f.flag").alias("flag"))
    sets = each.groupingSets([["country", "flag"], ["flag"], ["country"]], "country", "flag").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 0, "country_flag").when(F.col("g") == 2, "flag").otherwise("country")
    told = sets.withColumn("level", level).drop("g")
    place = F.when(F.col("level") == "country", F.row_number().over(Window.partitionBy("level").orderBy(F.desc("n"), "country")))
    ranked = told.filter("level = 'country'").withColumn("place", place)  # a row a country
    rest = told.filter("level <> 'country'").withColumn("place", F.lit(None).cast("int"))
    return ranked.unionByName(rest).select("level", "country", "flag", "n", "place")


def top_countries(counts: DataFrame, most: int = 10) -> DataFrame:
    """(country, n, place) of the countries with most flags."""
    return counts.filter(F.col("place") <= most).select("country", "n", "place")


def disagree(a: Column, b: Column) -> Column:
    """Whether two company names, both there, are different companies."""
    x, y = names.entity(a), names.entity(b)
    return (x != "") & (y != "") & (x != y)
