"""Queries of catalog graphs, flag rollups, company lookups and ship anchors, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import pages
from .operators import indexes, relational
from .plans import catalog
from .plans.traversal import export
from .queries import OWNERS, _pick, _sql_pick, _t, stale_sweep
from .queries import oracle_sql as _own_sql

#: The test tables' catalog as an information schema has it: keys, and links with their targets.
_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey"}
_LINKS = [("nation", "n_regionkey", "region"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"), ("orders", "o_custkey", "customer"), ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_suppkey", "supplier"), ("lineitem", "l_partkey", "part")]


def information_schema(spark: SparkSession) -> dict[str, DataFrame]:
    """The four views, with a key of two columns for lineitem."""
    schema = "public"
    constraints = [(schema, f"{t}_pk", schema, t, "PRIMARY KEY") for t in [*_KEYS, "lineitem"]] + [(schema, f"{t}_{c}_fk", schema, t, "FOREIGN KEY") for t, c, _ in _LINKS]
    usage = [(schema, f"{t}_pk", schema, t, c, 1, None) for t, c in _KEYS.items()] + [(schema, "lineitem_pk", schema, "lineitem", c, i, None) for i, c in enumerate(("l_orderkey", "l_linenumber"), 1)] + [(schema, f"{t}_{c}_fk", schema, t, c, 1, 1) for t, c, _ in _LINKS]
    references = [(schema, f"{t}_{c}_fk", schema, f"{to}_pk") for t, c, to in _LINKS]
    name = "constraint_schema string, constraint_name string"
    return {
        "tables": spark.createDataFrame([(schema, t) for t in [*_KEYS, "lineitem"]], "table_schema string, table_name string"),
        "table_constraints": spark.createDataFrame(constraints, f"{name}, table_schema string, table_name string, constraint_type string"),
        "key_column_usage": spark.createDataFrame(usage, f"{name}, table_schema string, table_name string, column_name string, ordinal_position int, position_in_unique_constraint int"),
        "referential_constraints": spark.createDataFrame(references, f"{name}, unique_constraint_schema string, unique_constraint_name string"),
    }


def catalog_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that hang on two regions, by the graph that the catalog gives; parts are a reference table, and a table that is not there is none."""
    graph = catalog.graph(information_schema(spark), reference=("part", "no_such_table"))
    step = next(s for s in graph.walk("region", depth=4) if s.table == "lineitem")
    return export(step, {t: _t(spark, sf_dir, t) for t in graph.keys}, "r_name IN ('ASIA', 'EUROPE')").select("l_orderkey", "l_linenumber", "l_quantity")


def flag_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = stale_sweep(spark, sf_dir).groupBy("o_orderkey", "status").agg(F.collect_list(F.struct("flag")).alias("flags"))
    return indexes.flag_counts(flagged, "status")


def most_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = stale_sweep(spark, sf_dir).join(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").join(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("country "), F.col("c_custkey") % 37).alias("country")), "o_custkey")
    return indexes.top_countries(indexes.flag_counts(flagged.select("country", F.array(F.struct("flag")).alias("flags"))))


def entity_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    units = o.select(F.col("o_custkey").cast("string").alias("terminal_id"), F.lit("x").alias("country"), _pick(OWNERS, F.col("o_orderkey")).alias("owner"), _pick(OWNERS, F.col("o_custkey")).alias("operator"), F.when(F.col("o_custkey") % 3 > 0, F.concat(F.lit("E"), F.col("o_custkey") % 7)).alias("parent"))
    out = indexes.find_entity(units, "Royal Dutch Shell", ["owner", "operator"], parent_id="parent")
    return out.withColumn("parent_ids", F.array_join("parent_ids", ","))


def ship_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship numbers from pages of search results: a page lists three ships, of which the number of one may be too far off."""
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    ship = lambda n, gap: F.concat(F.lit('<li><a href="/v/'), (F.col("k") + n).cast("string"), F.lit('">Ship '), (F.col("k") + n).cast("string"), F.lit(" Star</a> "), gap, F.lit(" IMO: "), (1_000_000 + F.col("k") + n).cast("string"), F.lit(", built 2001</li>"))
    far = F.when(F.col("k") % 3 == 0, F.lpad(F.lit(""), 250, "x ")).otherwise("gas carrier,")
    body = F.concat(F.lit('<ul><a href="/">Home</a>'), ship(7000, F.lit("tanker")), ship(0, far), ship(9000, F.lit("tanker")), F.lit("</ul>"))
    told = s.select("k", pages.best_anchor(body, F.concat(F.lit(" SHIP "), F.col("k").cast("string"), F.lit(" star "))).alias("x"))
    return told.select("k", "x.number", "x.warning")


def technology_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of JSON lists of ids, some of which are no ids, unknown or no list."""
    o = _t(spark, sf_dir, "orders")
    ids = F.when(F.col("o_orderkey") % 7 == 0, "none").otherwise(F.concat(F.lit("["), F.col("o_orderkey") % 25, F.lit(', "x", '), F.col("o_custkey") % 30, F.lit(', "3"]')))
    return relational.named_ids(o.select("o_orderkey", ids.alias("ids")), "o_orderkey", "ids", _t(spark, sf_dir, "nation"), "n_nationkey", "n_name")


def owner_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of an order as its owners, by falling share, those without share last, then by number."""
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") % 3 > 0, F.floor(F.col("l_quantity") / 10)).alias("share"))
    out = relational.ordered_lists(lines, "l_orderkey", [F.desc_nulls_last("share"), F.asc("l_linenumber")], ["l_linenumber", "share"], "owners")
    return out.select("l_orderkey", F.array_join(F.transform("owners", lambda x: F.concat_ws(":", x.l_linenumber.cast("string"), F.coalesce(x.share.cast("string"), F.lit("-")))), ",").alias("owners"))


SHIPS = """SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(1000000 + s_suppkey AS VARCHAR) END AS number,
  CASE WHEN s_suppkey % 3 = 0 THEN 'numbers without a name: ' || array_to_string([CAST(1000000 + s_suppkey + d AS VARCHAR) FOR d IN [0, 7000, 9000]], ', ') END AS warning FROM supplier"""


def queries() -> dict:
    return {f.__name__: f for f in (catalog_export, flag_rollup, most_flagged, entity_parents, ship_anchors, technology_names, owner_order)}


def oracle_sql() -> dict[str, str]:
    flags = _own_sql()["stale_sweep"]
    pick = _sql_pick(OWNERS, "{}")
    return {
        "catalog_export": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))",
        "flag_rollup": f"""WITH f AS ({flags}), c AS (SELECT status AS country, flag, count(*) AS n, grouping(status) AS gs, grouping(flag) AS gf FROM f GROUP BY GROUPING SETS ((status, flag), (flag), (status)))
            SELECT CASE WHEN gs = 1 THEN 'flag' WHEN gf = 1 THEN 'country' ELSE 'country_flag' END AS level, country, flag, n, CASE WHEN gf = 1 THEN CAST(row_number() OVER (PARTITION BY gf ORDER BY n DESC, country) AS INTEGER) END AS place FROM c""",
        "most_flagged": f"""WITH f AS ({flags}), c AS (SELECT 'country ' || CAST(o_custkey % 37 AS VARCHAR) AS country, count(*) AS n FROM f JOIN orders USING (o_orderkey) JOIN customer ON c_custkey = o_custkey GROUP BY 1)
            SELECT country, n, CAST(row_number() OVER (ORDER BY n DESC, country) AS INTEGER) AS place FROM c QUALIFY place <= 10""",
        "entity_parents": f"""WITH u AS (SELECT o_custkey, 'owner' AS field, {pick.format('o_orderkey')} AS value FROM orders UNION ALL SELECT o_custkey, 'operator', {pick.format('o_custkey')} FROM orders),
            hit AS (SELECT o_custkey, field, CASE WHEN value LIKE 'Shell plc%' THEN 'Shell plc' ELSE 'Big Shell Trading 10' END AS variant FROM u WHERE value LIKE '%Shell%')
            SELECT field, variant, count(*) AS hits, count(DISTINCT o_custkey) AS n_terminals, array_to_string(list_sort(coalesce(list(DISTINCT 'E' || CAST(o_custkey % 7 AS VARCHAR)) FILTER (field = 'owner' AND o_custkey % 3 > 0), [])), ',') AS parent_ids FROM hit GROUP BY ALL""",
        "ship_anchors": SHIPS,
        "technology_names": """WITH e AS (SELECT o_orderkey, unnest([1, 2, 3]) AS pos, unnest([o_orderkey % 25, o_custkey % 30, 3]) AS id FROM orders WHERE o_orderkey % 7 <> 0)
            SELECT o.o_orderkey, coalesce(string_agg(n_name, ', ' ORDER BY pos), '') AS names FROM orders o LEFT JOIN e ON e.o_orderkey = o.o_orderkey LEFT JOIN nation ON n_nationkey = id GROUP BY o.o_orderkey""",
        "owner_order": """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity % 3 > 0 THEN CAST(floor(l_quantity / 10) AS BIGINT) END AS share FROM lineitem)
            SELECT l_orderkey, string_agg(l_linenumber || ':' || coalesce(CAST(share AS VARCHAR), '-'), ',' ORDER BY share DESC NULLS LAST, l_linenumber) AS owners FROM l GROUP BY l_orderkey""",
    }
