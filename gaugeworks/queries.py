"""Queries of the reconciliation operators over the relational test tables, and the SQL that gives the same rows.

The tables stand in for an asset database: regions to line items are the graph of tables, orders the units,
line items their entries, events the status log. Where an operator needs names, they are made from keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import capacity, formats, lifecycle, names, pages
from .operators import indexes, reconcile, relational
from .plans.traversal import ForeignKey, Graph, export
from .sources import flat
from .streaming import latest

TABLES = "region nation customer supplier part orders lineitem events".split()
GRAPH = Graph(
    keys={"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": None},
    links=(ForeignKey("nation", "n_regionkey", "region", "r_regionkey"), ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"), ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"), ForeignKey("orders", "o_custkey", "customer", "c_custkey"), ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"), ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"), ForeignKey("lineitem", "l_partkey", "part", "p_partkey")),
)
SPELLINGS = ["USA", " U.S. ", "Korea, South", "Viet Nam", "Turkey (new)", "Great Britain", "Cabo  Verde", "Atlantis.", "Macau", "Ivory Coast"]
COUNTRY_TAGS = ["united states", "united states", "south korea", "vietnam", "türkiye", "united kingdom", "cape verde", "atlantis", "macao", "côte d'ivoire"]
OWNERS = ["Shell plc 50%, Total SA 50%", "Cheniere Energy Partners (30%)", "Nobody Known [12.5%]; BP", "Mitsui O.S.K. Lines", "Big Shell Trading 10 %"]
STATUSES = ["proposed", "construction", "operating", "shelved", "cancelled", "FID"]
TODAY = "2002-01-01"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _sql_pick(values: list[str], number: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{listed}])[CAST({number} % {len(values)} AS INTEGER) + 1]"


# ---------------------------------------------------------------- scans, graph of tables, joins


def table_graph_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: _t(spark, sf_dir, t) for t in GRAPH.keys}
    step = next(s for s in GRAPH.walk("region", depth=4) if s.table == "lineitem")
    return export(step, tables, "r_name IN ('ASIA', 'EUROPE')").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def tracker_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = _t(spark, sf_dir, "orders").filter("o_totalprice > 400000 AND o_orderstatus = 'F'")
    return _t(spark, sf_dir, "customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


def lookup_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = relational.with_lookups(_t(spark, sf_dir, "customer"), {"c_nationkey": (_t(spark, sf_dir, "nation"), "n_nationkey", "n_name")})
    return own.select("c_custkey", F.col("c_nationkey_n_name").alias("nation"))


def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = relational.latest_by(_t(spark, sf_dir, "orders"), "o_custkey", [F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_orderstatus")


def anti_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _t(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    return _t(spark, sf_dir, "customer").join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def resolved_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem")
    units = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x.l_partkey).alias("refs"))
    return relational.resolve_refs(units, "l_orderkey", "refs", _t(spark, sf_dir, "part"), "p_partkey", "p_name")


def _companies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    own = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("company"), (F.col("s_suppkey") % 3).alias("m"))
    up = own.filter("company > 3").select("company", F.floor(F.col("company") / 2).alias("owner"), F.lit(60).cast("decimal(18,6)").alias("share"))
    side = own.filter("company > 3 AND m = 0").select("company", F.floor(F.col("company") / 3).alias("owner"), F.lit(None).cast("decimal(18,6)").alias("share"))
    circle = own.filter("company = 3").select("company", F.lit(6).cast("bigint").alias("owner"), F.lit(10).cast("decimal(18,6)").alias("share"))
    return own.select("company"), up.unionByName(side).unionByName(circle)


def ultimate_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, edges = _companies(spark, sf_dir)
    out = relational.ultimate_parents(own, edges, own.filter("company = 2"))
    return out.select("start", "parent", F.round(F.col("share").cast("double"), 6).alias("share"))


def back_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, F.floor(F.col("s_suppkey") / 4)).alias("replaced_by"))
    out = relational.back_references(own, "s_suppkey", "replaced_by", "replaces")
    return out.select("s_suppkey", F.array_join(F.transform("replaces", lambda x: x.cast("string")), ",").alias("replaces"))


# ---------------------------------------------------------------- totals, indexes, lists


def rounded_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "Import").when(F.col("l_returnflag") == "R", "EXPORT")
    value = (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.735").cast("decimal(4,3)")).cast("decimal(20,5)")
    cost = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("decimal(18,2)"))
    out = relational.rounded_totals(_t(spark, sf_dir, "lineitem"), "l_orderkey", kind, value, cost)
    return out.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in ("import_total", "export_total", "cost_total")])


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row"),
        F.col("o_orderkey").cast("string").alias("unit_id"),
        F.col("o_custkey").cast("string").alias("terminal_id"),
        _pick(SPELLINGS, F.col("o_custkey")).alias("country"),
        F.concat(F.lit("Site "), (F.col("o_custkey") % 500).cast("string"), _pick([" LNG Terminal", " FSRU", " (FSRU)", "", " Import Terminal FSRU"], F.col("o_orderkey"))).alias("terminal_name"),
        F.concat(F.lit("Train "), (F.col("o_orderkey") % 4).cast("string")).alias("unit_name"),
        _pick(OWNERS, F.col("o_custkey") + F.col("o_orderkey")).alias("owner"),
        _pick(["Export", "Import", "Import", "Bunker"], F.col("o_custkey")).alias("facility"),
        _pick(["operating", "Operating", "proposed", "shelved"], F.col("o_orderkey")).alias("status"),
        (F.floor(F.col("o_totalprice") / 1000) / 4).alias("capacity"),
        (F.col("o_orderkey") % 7 == 0).alias("floating"),
        F.concat_ws(" ", F.lit("Vessel"), (F.col("o_orderkey") % 50).cast("string")).alias("vessel_name"),
    )


_UNITS = f"""units AS (
  SELECT o_orderkey AS row, CAST(o_orderkey AS VARCHAR) AS unit_id, CAST(o_custkey AS VARCHAR) AS terminal_id,
    {_sql_pick(COUNTRY_TAGS, 'o_custkey')} AS country_norm,
    'site ' || CAST(o_custkey % 500 AS VARCHAR) || {_sql_pick(['', '', '', '', ' import terminal'], 'o_orderkey')} AS name_norm,
    'Site ' || CAST(o_custkey % 500 AS VARCHAR) || {_sql_pick([' LNG Terminal', ' FSRU', ' (FSRU)', '', ' Import Terminal FSRU'], 'o_orderkey')} AS terminal_name,
    'Train ' || CAST(o_orderkey % 4 AS VARCHAR) AS unit_name,
    {_sql_pick(['liquefaction', 'regasification', 'regasification', 'unknown'], 'o_custkey')} AS section,
    {_sql_pick(['operating', 'operating', 'proposed', 'shelved'], 'o_orderkey')} AS status,
    floor(o_totalprice / 1000) / 4 AS capacity, o_orderkey % 7 = 0 AS floating,
    (o_custkey + o_orderkey) % 5 AS own
  FROM orders)"""


def site_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.site_index(_units(spark, sf_dir)).drop("rows")


def sponsor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.sponsor_index(_units(spark, sf_dir))


def top_sponsors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.top_sponsors(indexes.sponsor_index(_units(spark, sf_dir))).select("country_norm", "sponsor", "n_units")


def unit_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 9 > 0, F.col("l_orderkey").cast("string")).otherwise("").alias("unit_id"), F.col("l_linenumber").alias("row"), "l_partkey", "l_quantity")
    return indexes.unit_index(lines).select("unit_id", "row", "l_partkey", "l_quantity")


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.index_stats(_units(spark, sf_dir))


def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.find_entity(_units(spark, sf_dir), "Royal Dutch Shell", ["owner"], "U.S.A.")


def project_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reconcile.projects(_units(spark, sf_dir))
    return out.select("country_norm", "name_norm", "section", "terminal_id", F.array_join("statuses", ",").alias("statuses"), "capacity", "n_operating", "n_units", "floating", F.array_join("unit_names", ",").alias("unit_names"))


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.collisions(_units(spark, sf_dir)).filter("section <> 'unknown'")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    own = flat.checkpointed(reconcile.projects(_units(spark, sf_dir)))  # both sides and every pass read it
    part = F.regexp_extract("name_norm", "[0-9]+", 0).cast("int") % 5
    report = own.filter(part < 4).withColumn("capacity", F.when(part == 0, F.col("capacity") * 1.5).otherwise(F.col("capacity")))
    return report, own.filter(part > 0)


def _other_names(spark: SparkSession, sf_dir: str, register: DataFrame) -> DataFrame:
    """Every third customer's terminals also go by the name of the next site."""
    units = _units(spark, sf_dir).filter("CAST(terminal_id AS LONG) % 3 = 0")
    number = F.regexp_extract("terminal_name", "[0-9]+", 0).cast("int")
    named = units.select(names.country(F.col("country")).alias("country_norm"), names.site(F.col("terminal_name")).alias("name_norm"), reconcile.section_of(F.col("facility")).alias("section"), F.concat(F.lit("Site "), ((number + 1) % 500).cast("string")).alias("other"), "row")
    return named.join(register.select(*reconcile.KEY), reconcile.KEY, "left_semi").groupBy(*reconcile.KEY, "other").agg(F.min("row").alias("row"))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, register = _sides(spark, sf_dir)
    other = _other_names(spark, sf_dir, register)
    every = other.select("country_norm", names.site(F.col("other")).alias("alias_norm"), "section", F.col("name_norm").alias("register_name"))
    return reconcile.reconcile(report, register, reconcile.aliases(register, other), other=every)


def exact_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, register = _sides(spark, sf_dir)
    return reconcile.match_keys(report, register, reconcile.aliases(register, _other_names(spark, sf_dir, register)))


def monitor_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    prior = c.filter("c_custkey % 3 <> 0").select((F.col("c_custkey") % 10).alias("country"), F.col("c_custkey").alias("candidate"), F.lit("b1").alias("first_batch"), F.lit("b1").alias("last_batch"), F.col("c_mktsegment").alias("note"))
    now = c.filter("c_custkey % 2 = 0").select((F.col("c_custkey") % 10).alias("country"), F.col("c_custkey").alias("candidate"), F.lit("b2").alias("first_batch"), F.lit("b2").alias("last_batch"), F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise("new").alias("note"))
    return relational.upsert(prior, now, ["country", "candidate"], ["first_batch"])


def field_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.agreement(_t(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


def value_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.runs(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type")


def vessel_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("row"), F.concat_ws(" ", F.lit("VESSEL"), (F.col("s_suppkey") * 3 % 60).cast("string")).alias("vessel_name"))
    return indexes.match_vessels(_units(spark, sf_dir).select("unit_id", "vessel_name"), other)


def total_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("v"))
    return reconcile.total_gate(own, "l_returnflag", "v", {"A": 500000.0, "R": 1.0})


# ---------------------------------------------------------------- lifecycle


def _timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("event_id").alias("order"), _pick(STATUSES, F.col("event_id") + F.floor(F.col("value"))).alias("status"), _pick(["", "planned", "actual", "inferred 2 y"], F.floor(F.col("value"))).alias("substatus"), F.when(F.col("event_id") % 3 > 0, 1990 + F.col("event_id") % 40).cast("int").alias("year"), F.lit(None).cast("string").alias("month"), F.array("user_id").alias("refs"))
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(entry).alias("timeline"))


def status_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = lifecycle.anchors(F.col("timeline"))
    keep = ["status", "substatus", "proposal_year", "construction_year", "original_planned_start", "latest_planned_start", "actual_start", "actual_start_2", "shelved_year", "cancelled_year", "stop_year", "fid_status", "fid_year"]
    return _timelines(spark, sf_dir).select("user_id", a.alias("a")).select("user_id", *[F.col(f"a.{k}").alias(k) for k in keep])


def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timelines(spark, sf_dir).select("user_id", lifecycle.current_strict(F.col("timeline")).alias("status"))


_ENTRIES = f"""entries AS (
  SELECT user_id, event_id, {_sql_pick(STATUSES, '(event_id + CAST(floor(value) AS BIGINT))')} AS status,
    {_sql_pick(['', 'planned', 'actual', 'inferred 2 y'], 'CAST(floor(value) AS BIGINT)')} AS substatus,
    CASE WHEN event_id % 3 > 0 THEN 1990 + event_id % 40 END AS year
  FROM events)"""


def stale_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "orders").select("o_orderkey", _pick(["proposed", "operating", "shelved", "idled"], F.col("o_orderkey")).alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_updated"), (1996 + F.col("o_orderkey") % 8).cast("string").alias("planned"))
    flags = lifecycle.stale_flags(F.col("status"), lifecycle.parse_date(F.col("last_updated")), F.col("planned"), F.to_date(F.lit(TODAY)))
    return own.select("o_orderkey", "status", F.explode(flags).alias("f")).select("o_orderkey", "status", "f.flag", "f.severity")


def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale_sweep(spark, sf_dir).groupBy("status", "flag").agg(F.count("*").alias("n"))


def legal_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _t(spark, sf_dir, "nation").select("n_nationkey", _pick(list(lifecycle.MOVES), F.col("n_nationkey")).alias("before"), _pick([*lifecycle.MOVES, "unheard"], F.col("n_nationkey") * 2).alias("after"))
    return pairs.withColumn("legal", lifecycle.legal_move(F.col("before"), F.col("after")))


def anchor_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    y = {"proposal": (2000 + k % 7).cast("string"), "construction": (2000 + k % 5).cast("string"), "actual_start": F.when(k % 3 == 0, "none").otherwise((2001 + k % 4).cast("string"))}
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.array_join(lifecycle.anchor_warnings(y), ",").alias("warnings"))


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("unit_id"), "ts", F.col("event_type").alias("status"), F.when(F.col("value") > 50, "planned").alias("substatus"))
    return latest.latest(e).select("unit_id", "status")


def weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select("ts", F.col("event_type").alias("status"))
    return latest.windowed_counts(e, "1 hour")


# ---------------------------------------------------------------- scalar functions


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").select("c_custkey", names.country(_pick(SPELLINGS, F.col("c_custkey"))).alias("country"))


def owner_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _t(spark, sf_dir, "customer").select("c_custkey", F.posexplode(names.entity_list(_pick(OWNERS, F.col("c_custkey")))).alias("pos", "x"))
    return each.select("c_custkey", "pos", "x.entity", "x.pct")


_OWNER_ROWS = "(VALUES (0, 0, 'shell', 50.0), (0, 1, 'totalenergies', 50.0), (1, 0, 'cheniere', 30.0), (2, 0, 'nobody known', 12.5), (2, 1, 'bp', NULL), (3, 0, 'mol', NULL), (4, 0, 'shell', 10.0)) AS o(k, pos, entity, pct)"


def capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    unit = _pick(["mtpa", "BCM/y ", "bcf/d", "furlongs"], k)
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.round(capacity.to_mtpa(F.col("o_totalprice").cast("string"), unit), 6).alias("mtpa"), capacity.rendered_mtpa(F.floor(F.col("o_totalprice")), unit).cast("double").alias("shown"))


def capacity_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ["3.1 mtpa", "3.1 to 4.4 mtpa", "3.1-4.4 MTPA", "circa 8.25 bcm/y", "unknown"]
    r = capacity.for_database(_pick(texts, F.col("p_partkey")))
    return _t(spark, sf_dir, "part").select("p_partkey", r.value.alias("value"), r.unit.alias("unit"), r.note.alias("note"))


def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = (F.col("p_size").cast("decimal(18,6)") / 4).cast("decimal(18,6)")
    return _t(spark, sf_dir, "part").select("p_partkey", formats.number(x).alias("plain"), formats.fixed2(x).alias("fixed"), formats.at_least_one_decimal(x).alias("one"), formats.owner_share(x).alias("share"), formats.parent_share(x).alias("parent"), formats.year_range(F.col("p_size"), F.col("p_size") + F.col("p_partkey") % 2).alias("years"))


def page_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("page_id") % 11 == 0, "503").otherwise("200")
    check = pages.verify(status, F.col("html"), F.array(F.lit("ARTICLE"), F.lit("the")))
    return _t(spark, sf_dir, "pages").select("page_id", check.ok.alias("ok"), check.reason.alias("reason"))


def sheet_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 17 == 0, "#REF!").otherwise(F.col("c_name")).alias("a"), F.when(F.col("c_custkey") % 19 == 0, "=A1").otherwise("=").alias("b"))
    return flat.sheet_errors(own, "c_custkey")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report held against a register: every project of both sides in one bucket."""
    return reconciliation(spark, sf_dir)


_ALL = [table_graph_export, tracker_exists, lookup_joins, latest_row, anti_difference, resolved_references, ultimate_parents, back_references, rounded_totals, site_index, sponsor_index, top_sponsors, unit_index, index_stats, entity_lookup, project_collapse, collisions, exact_matches, reconciliation, monitor_upsert, field_agreement, value_runs, vessel_match, total_gates, status_columns, current_status, stale_sweep, flag_counts, legal_moves, anchor_checks, latest_status, weekly_counts, country_names, owner_lists, capacities, capacity_ranges, number_formats, page_checks, sheet_errors]


def queries() -> dict:
    return {f.__name__: f for f in _ALL}


_MOVES_SQL = ", ".join(f"('{a}', '{b}')" for a, v in lifecycle.MOVES.items() for b in v.split())
_SPONSORS = f"""WITH {_UNITS}, o AS (SELECT * FROM (VALUES (0, 'shell'), (0, 'totalenergies'), (1, 'cheniere'), (2, 'nobody known [12.5%];'), (3, 'mol'), (4, 'shell')) AS o(k, sponsor))
SELECT country_norm, sponsor, count(*) AS n_units, count(DISTINCT terminal_id) AS n_terminals FROM units JOIN o ON own = k GROUP BY ALL"""
_STALE = f"""WITH u AS (SELECT o_orderkey, {_sql_pick(['proposed', 'operating', 'shelved', 'idled'], 'o_orderkey')} AS status,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '{TODAY}') / 365.25 AS age, 1996 + o_orderkey % 8 AS planned FROM orders),
f AS (
  SELECT o_orderkey, status, 'inferred_shelved_candidate' AS flag, 'high' AS severity FROM u WHERE status IN ('proposed', 'idled') AND age >= 2
  UNION ALL SELECT o_orderkey, status, 'inferred_cancelled_candidate', 'high' FROM u WHERE status = 'shelved' AND age >= 2
  UNION ALL SELECT o_orderkey, status, 'routine_refresh_due', 'low' FROM u WHERE status = 'operating' AND age >= 1.5
  UNION ALL SELECT o_orderkey, status, 'planned_start_slipped', 'medium' FROM u WHERE status = 'proposed' AND planned < 2001)"""


#: The report's and the register's projects, their other names, and the matches by key and alias.
_SIDES = f"""{_UNITS},
  tags AS (SELECT * FROM (VALUES (0, 'shell'), (0, 'totalenergies'), (1, 'cheniere'), (2, 'nobody known'), (2, 'bp'), (3, 'mol'), (4, 'shell')) AS t(own, tag)),
  numbered AS (SELECT *, CAST(regexp_extract(name_norm, '[0-9]+') AS INTEGER) AS number FROM units WHERE section <> 'unknown'),
  proj AS (SELECT country_norm, name_norm, section, any_value(number) AS number, list_distinct(list(tag)) AS owners FROM numbered JOIN tags USING (own) GROUP BY country_norm, name_norm, section),
  report AS (SELECT * FROM proj WHERE number % 5 < 4), register AS (SELECT * FROM proj WHERE number % 5 > 0),
  others AS (SELECT country_norm, section, name_norm AS register_name, 'site ' || CAST((number + 1) % 500 AS VARCHAR) AS alias, min(row) AS row FROM numbered SEMI JOIN register USING (country_norm, name_norm, section) WHERE CAST(terminal_id AS BIGINT) % 3 = 0 GROUP BY ALL),
  alias AS (SELECT * FROM others o WHERE alias <> register_name AND NOT EXISTS (SELECT 1 FROM register r WHERE r.country_norm = o.country_norm AND r.section = o.section AND r.name_norm = o.alias)
    QUALIFY row_number() OVER (PARTITION BY country_norm, alias, section ORDER BY row, register_name) = 1),
  first AS (SELECT p.country_norm, p.name_norm, p.section, coalesce(r.name_norm, a.register_name) AS register_name, CASE WHEN r.name_norm IS NOT NULL THEN 'exact' ELSE 'alias' END AS how
    FROM report p LEFT JOIN register r USING (country_norm, name_norm, section) LEFT JOIN alias a ON a.country_norm = p.country_norm AND a.section = p.section AND a.alias = p.name_norm WHERE r.name_norm IS NOT NULL OR a.alias IS NOT NULL)"""
#: The fuzzy pass as it is defined: report projects by name, each takes the one candidate that is left.
_RECONCILED = f"""WITH RECURSIVE {_SIDES},
  words AS (SELECT country_norm, section, name_norm, owners, list_filter(list_distinct(string_split(name_norm, ' ')), lambda w: len(w) >= 4) AS w FROM proj),
  left_over AS (SELECT w.* FROM words w SEMI JOIN report USING (country_norm, name_norm, section) ANTI JOIN first USING (country_norm, name_norm, section)),
  free AS (SELECT w.country_norm, w.section, w.name_norm AS register_name, w.owners, w.w FROM words w SEMI JOIN register USING (country_norm, name_norm, section) WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.country_norm = w.country_norm AND f.section = w.section AND f.register_name = w.name_norm)),
  named AS (SELECT free.*, list_concat([register_name], coalesce((SELECT list(alias) FROM others o WHERE o.country_norm = free.country_norm AND o.section = free.section AND o.register_name = free.register_name), [])) AS every FROM free),
  pairs AS (SELECT l.country_norm, l.section, l.name_norm, n.register_name FROM left_over l JOIN named n ON n.country_norm = l.country_norm AND n.section = l.section
    WHERE len(list_filter(n.every, lambda x: contains(x, l.name_norm) OR contains(l.name_norm, x))) > 0
      OR (len(list_intersect(l.w, n.w)) >= 1 AND len(list_intersect(l.owners, n.owners)) > 0) OR len(list_intersect(l.w, n.w)) >= 2),
  asked AS (SELECT country_norm, section, name_norm, list(register_name ORDER BY register_name) AS c FROM pairs GROUP BY ALL),
  turn AS (SELECT *, row_number() OVER (PARTITION BY country_norm, section ORDER BY name_norm) AS k FROM asked),
  walk AS (
    SELECT country_norm, section, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS name_norm, CAST([] AS VARCHAR[]) AS l FROM turn WHERE k = 1
    UNION ALL
    SELECT country_norm, section, k, CASE WHEN len(l) = 1 THEN list_concat(taken, l) ELSE taken END, name_norm, l
    FROM (SELECT t.country_norm, t.section, t.k, w.taken, t.name_norm, list_filter(t.c, lambda x: NOT list_contains(w.taken, x)) AS l FROM walk w JOIN turn t ON t.country_norm = w.country_norm AND t.section = w.section AND t.k = w.k + 1)),
  second AS (SELECT country_norm, name_norm, section, CASE WHEN len(l) = 1 THEN l[1] END AS register_name, CASE WHEN len(l) = 1 THEN 'fuzzy' ELSE 'ambiguous' END AS how FROM walk WHERE k > 0 AND len(l) > 0),
  matched AS (SELECT * FROM first UNION ALL SELECT * FROM second)
SELECT * FROM matched
UNION ALL SELECT country_norm, name_norm, section, NULL, 'report_only' FROM report ANTI JOIN matched USING (country_norm, name_norm, section)
UNION ALL SELECT country_norm, name_norm, section, name_norm, 'register_only' FROM register r WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.country_norm = r.country_norm AND m.section = r.section AND m.register_name = r.name_norm)"""


def oracle_sql() -> dict[str, str]:
    return {
        "exact_matches": f"WITH {_SIDES} SELECT * FROM first",
        "reconciliation": _RECONCILED,
        "table_graph_export": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))))",
        "tracker_exists": "SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 400000 AND o_orderstatus = 'F')",
        "lookup_joins": "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
        "latest_row": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1",
        "anti_difference": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 300000)",
        "resolved_references": "SELECT l_orderkey, coalesce(string_agg(p_name, ', ' ORDER BY l_linenumber, l_partkey), '') AS refs_text FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey",
        "ultimate_parents": """WITH RECURSIVE e AS (
            SELECT s_suppkey AS company, s_suppkey // 2 AS owner, 60.0 AS share FROM supplier WHERE s_suppkey > 3
            UNION ALL SELECT s_suppkey, s_suppkey // 3, NULL FROM supplier WHERE s_suppkey > 3 AND s_suppkey % 3 = 0
            UNION ALL SELECT s_suppkey, 6, 10.0 FROM supplier WHERE s_suppkey = 3),
          walk AS (
            SELECT s_suppkey AS start, s_suppkey AS spot, CAST(100 AS DOUBLE) AS share, CAST([] AS BIGINT[]) AS path FROM supplier
            UNION ALL
            SELECT start, owner, w.share * coalesce(e.share, 100) / 100, list_append(path, spot) FROM walk w JOIN e ON e.company = w.spot
            WHERE w.spot <> 2 AND NOT list_contains(path, w.spot))
          SELECT start, spot AS parent, round(share, 6) AS share FROM walk WHERE spot = 2 OR list_contains(path, spot) OR spot NOT IN (SELECT company FROM e)""",
        "back_references": "SELECT s.s_suppkey, coalesce(string_agg(CAST(b.s_suppkey AS VARCHAR), ',' ORDER BY b.s_suppkey), '') AS replaces FROM supplier s LEFT JOIN supplier b ON b.s_suppkey % 4 = 0 AND b.s_suppkey // 4 = s.s_suppkey GROUP BY s.s_suppkey",
        "rounded_totals": """SELECT l_orderkey,
            CAST(nullif(sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.735 AS DECIMAL(4,3)), 2)) FILTER (l_returnflag = 'A'), 0) AS DOUBLE) AS import_total,
            CAST(nullif(sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.735 AS DECIMAL(4,3)), 2)) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) AS export_total,
            CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O') AS DOUBLE) AS cost_total FROM lineitem GROUP BY l_orderkey""",
        "site_index": f"WITH {_UNITS} SELECT country_norm, name_norm, count(*) AS n_units, count(DISTINCT terminal_id) AS n_terminals FROM units GROUP BY ALL",
        "sponsor_index": _SPONSORS,
        "unit_index": "SELECT CAST(l_orderkey AS VARCHAR) AS unit_id, l_linenumber AS row, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 9 > 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC) = 1",
        "index_stats": f"""WITH {_UNITS}, p AS (SELECT country_norm, name_norm, count(*) AS n FROM units GROUP BY ALL)
            SELECT (SELECT count(*) FROM units) AS n_rows, (SELECT count(DISTINCT terminal_id) FROM units) AS n_terminals, (SELECT count(*) FROM p) AS project_keys,
              (SELECT count(*) FROM ({_SPONSORS})) AS sponsor_keys, (SELECT count(DISTINCT unit_id) FROM units) AS unit_keys, (SELECT count(*) FROM p WHERE n > 1) AS multi_unit_projects""",
        "top_sponsors": f"SELECT country_norm, sponsor, n_units FROM ({_SPONSORS}) ORDER BY n_units DESC, country_norm, sponsor LIMIT 10",
        "entity_lookup": f"WITH {_UNITS} SELECT 'owner' AS field, CASE WHEN own = 0 THEN 'Shell plc' ELSE 'Big Shell Trading 10' END AS variant, count(*) AS hits, count(DISTINCT terminal_id) AS n_terminals FROM units WHERE own IN (0, 4) AND country_norm = 'united states' GROUP BY ALL",
        "project_collapse": f"""WITH {_UNITS} SELECT country_norm, name_norm, section, arg_min(terminal_id, row) AS terminal_id, array_to_string(list_sort(list_distinct(list(status))), ',') AS statuses,
            coalesce(sum(capacity) FILTER (status = 'operating'), 0) AS capacity, count(*) FILTER (status = 'operating') AS n_operating, count(*) AS n_units, bool_or(floating) AS floating,
            array_to_string(list_sort(list_distinct(list(unit_name))), ',') AS unit_names FROM units WHERE section <> 'unknown' GROUP BY country_norm, name_norm, section""",
        "collisions": f"WITH {_UNITS} SELECT country_norm, name_norm, section FROM units WHERE section <> 'unknown' GROUP BY ALL HAVING bool_or(floating) AND bool_or(NOT floating)",
        "monitor_upsert": """WITH a AS (SELECT c_custkey % 10 AS country, c_custkey AS candidate, 'b1' AS f, 'b1' AS l, c_mktsegment AS note FROM customer WHERE c_custkey % 3 <> 0),
            b AS (SELECT c_custkey % 10 AS country, c_custkey AS candidate, 'b2' AS f, 'b2' AS l, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'new' END AS note FROM customer WHERE c_custkey % 2 = 0)
            SELECT coalesce(b.country, a.country) AS country, coalesce(b.candidate, a.candidate) AS candidate, coalesce(a.f, b.f) AS first_batch, coalesce(b.l, a.l) AS last_batch, coalesce(nullif(b.note, ''), nullif(a.note, '')) AS note
            FROM a FULL JOIN b USING (country, candidate)""",
        "field_agreement": """WITH g AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS s, count(DISTINCT o_orderpriority) AS p FROM orders GROUP BY ALL HAVING count(*) > 1),
            f AS (SELECT 'o_orderstatus' AS field, count(*) AS groups, CAST(sum(CAST(s <= 1 AS INTEGER)) AS BIGINT) AS agreeing FROM g UNION ALL SELECT 'o_orderpriority', count(*), CAST(sum(CAST(p <= 1 AS INTEGER)) AS BIGINT) FROM g)
            SELECT *, CASE WHEN agreeing / groups >= 0.95 THEN 'project' WHEN agreeing / groups <= 0.3 THEN 'unit' ELSE 'mixed' END AS level FROM f""",
        "value_runs": """WITH n AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
            r AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS run FROM n)
            SELECT user_id, run, min(event_type) AS event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r GROUP BY user_id, run""",
        "vessel_match": """WITH v AS (SELECT lower('VESSEL ' || CAST(s_suppkey * 3 % 60 AS VARCHAR)) AS k, 'VESSEL ' || CAST(s_suppkey * 3 % 60 AS VARCHAR) AS other_name FROM supplier GROUP BY ALL),
            u AS (SELECT CAST(o_orderkey AS VARCHAR) AS unit_id, 'Vessel ' || CAST(o_orderkey % 50 AS VARCHAR) AS vessel_name FROM orders),
            d AS (SELECT DISTINCT vessel_name, lower(vessel_name) AS k FROM u),
            m AS (SELECT d.vessel_name, count(v.k) FILTER (v.k = d.k) AS e, count(v.k) AS n, min(other_name) FILTER (v.k = d.k) AS eo, min(other_name) AS o FROM d LEFT JOIN v ON contains(v.k, d.k) OR contains(d.k, v.k) GROUP BY d.vessel_name)
            SELECT unit_id, vessel_name, CASE WHEN e > 0 THEN eo WHEN n = 1 THEN o END AS other_name, CASE WHEN e > 0 THEN 'exact' WHEN n = 1 THEN 'contained' WHEN n = 0 THEN 'missing' ELSE 'ambiguous' END AS how FROM u JOIN m USING (vessel_name)""",
        "total_gates": "SELECT l_returnflag, total, expected, abs(total - expected) <= 0.02 * expected AS ok FROM (SELECT l_returnflag, sum(l_quantity) AS total, CASE l_returnflag WHEN 'A' THEN 500000.0::DOUBLE WHEN 'R' THEN 1.0::DOUBLE END AS expected FROM lineitem GROUP BY 1)",
        "current_status": f"WITH {_ENTRIES}, u AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, arg_max(lower(status), event_id) AS status FROM entries WHERE substatus <> 'planned' AND status <> 'FID' GROUP BY user_id) SELECT user_id, coalesce(status, '') AS status FROM u LEFT JOIN c USING (user_id)",
        "status_columns": f"""WITH {_ENTRIES}, s AS (SELECT *, row_number() OVER (PARTITION BY user_id, status = 'operating' AND substatus <> 'planned' ORDER BY event_id) AS nth FROM entries),
            g AS (SELECT user_id,
              coalesce(arg_max(status, event_id) FILTER (substatus <> 'planned' AND status <> 'FID'), arg_max(status, event_id) FILTER (status <> 'FID'), arg_max(status, event_id)) AS status,
              coalesce(arg_max(substatus, event_id) FILTER (substatus <> 'planned' AND status <> 'FID'), arg_max(substatus, event_id) FILTER (status <> 'FID'), arg_max(substatus, event_id)) AS substatus,
              coalesce(CAST(arg_min(year, event_id) FILTER (status = 'proposed' AND year IS NOT NULL) AS VARCHAR), '') AS proposal_year,
              coalesce(CAST(arg_min(year, event_id) FILTER (status = 'construction' AND year IS NOT NULL) AS VARCHAR), '') AS construction_year,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'operating' AND substatus = 'planned')[1] AS VARCHAR), '') AS original_planned_start,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'operating' AND substatus = 'planned')[-1] AS VARCHAR), '') AS latest_planned_start,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'operating' AND substatus <> 'planned')[1] AS VARCHAR), '') AS actual_start,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'operating' AND substatus <> 'planned')[2] AS VARCHAR), '') AS actual_start_2,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'shelved')[-1] AS VARCHAR), '') AS shelved_year,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'cancelled')[-1] AS VARCHAR), '') AS cancelled_year,
              coalesce(CASE WHEN count(*) FILTER (status = 'FID') = 0 THEN '' WHEN arg_max(substatus, event_id) FILTER (status = 'FID') = 'planned' THEN 'Pre-FID' ELSE 'FID' END, '') AS fid_status,
              coalesce(CAST(list(year ORDER BY event_id) FILTER (status = 'FID')[-1] AS VARCHAR), '') AS fid_year
              FROM s GROUP BY user_id)
            SELECT *, CASE WHEN cancelled_year <> '' THEN cancelled_year ELSE shelved_year END AS stop_year FROM g""",
        "stale_sweep": f"{_STALE} SELECT * FROM f",
        "flag_counts": f"{_STALE} SELECT status, flag, count(*) AS n FROM f GROUP BY ALL",
        "legal_moves": f"WITH m(a, b) AS (VALUES {_MOVES_SQL}), p AS (SELECT n_nationkey, {_sql_pick(list(lifecycle.MOVES), 'n_nationkey')} AS before, {_sql_pick([*lifecycle.MOVES, 'unheard'], '(n_nationkey * 2)')} AS after FROM nation) SELECT n_nationkey, before, after, before = after OR EXISTS (SELECT 1 FROM m WHERE a = before AND b = after) AS legal FROM p",
        "anchor_checks": """WITH y AS (SELECT o_orderkey, 2000 + o_orderkey % 7 AS p, 2000 + o_orderkey % 5 AS c, CASE WHEN o_orderkey % 3 <> 0 THEN 2001 + o_orderkey % 4 END AS a FROM orders)
            SELECT o_orderkey, array_to_string(list_filter([CASE WHEN p > c THEN 'proposal_after_construction' END, CASE WHEN c > a THEN 'construction_after_actual_start' END, CASE WHEN p > a THEN 'proposal_after_actual_start' END], lambda x: x IS NOT NULL), ',') AS warnings FROM y""",
        "latest_status": "SELECT user_id AS unit_id, arg_max(event_type, ts) AS status FROM events WHERE value <= 50 OR value IS NULL GROUP BY user_id",
        "weekly_counts": "SELECT date_trunc('hour', ts) AS start, event_type AS status, count(*) AS n FROM events GROUP BY ALL",
        "country_names": f"SELECT c_custkey, {_sql_pick(COUNTRY_TAGS, 'c_custkey')} AS country FROM customer",
        "owner_lists": f"SELECT c_custkey, pos, entity, CAST(pct AS DOUBLE) AS pct FROM customer JOIN {_OWNER_ROWS} ON c_custkey % 5 = k",
        "capacities": """SELECT o_orderkey, round(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE / 1.36 WHEN 2 THEN 365.0::DOUBLE / 130 END, 6) AS mtpa,
            CAST(round(CAST(floor(o_totalprice) AS DECIMAL(20,6)) * CASE o_orderkey % 4 WHEN 0 THEN CAST(1 AS DECIMAL(10,5)) WHEN 1 THEN CAST(0.735 AS DECIMAL(10,5)) WHEN 2 THEN CAST(7.67 AS DECIMAL(10,5)) END, 2) AS DOUBLE) AS shown FROM orders""",
        "capacity_ranges": "SELECT p_partkey, ([3.1, 4.4, 4.4, 8.25, NULL])[p_partkey % 5 + 1]::DOUBLE AS value, (['mtpa', 'mtpa', 'mtpa', 'bcm/y', NULL])[p_partkey % 5 + 1] AS unit, CASE WHEN p_partkey % 5 IN (1, 2) THEN 'Capacity reported as 3.1-4.4 mtpa range; database records max.' END AS note FROM part",
        "number_formats": """WITH q AS (SELECT p_partkey, p_size // 4 AS w, (['', '.25', '.5', '.75'])[p_size % 4 + 1] AS d, (['.00', '.25', '.50', '.75'])[p_size % 4 + 1] AS f, p_size, p_partkey % 2 AS odd FROM part)
            SELECT p_partkey, w || d AS plain, w || f AS fixed, w || CASE WHEN d = '' THEN '.0' ELSE d END AS one, w || d || '%' AS share, w || CASE WHEN d = '' THEN '.0' ELSE d END || '%' AS parent,
            CASE WHEN odd = 1 THEN p_size || '-' || (p_size + 1) ELSE CAST(p_size AS VARCHAR) END AS years FROM q""",
        "page_checks": f"""WITH t AS (SELECT page_id, html, lower(regexp_extract(html, '(?i)<title[^>]*>([^<]+)</title>', 1)) AS title FROM pages),
            r AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'HTTP 503' WHEN len(list_filter([{', '.join("'" + p + "'" for p in pages.SOFT_ERRORS)}], lambda p: contains(title, p))) > 0 THEN 'soft-error page' WHEN NOT (contains(lower(html), 'article') AND contains(lower(html), 'the')) THEN 'missing expected content' ELSE 'OK' END AS reason FROM t)
            SELECT page_id, reason = 'OK' AS ok, reason FROM r""",
        "sheet_errors": "SELECT c_custkey, 'a' AS field, '#REF!' AS value, 'error' AS kind FROM customer WHERE c_custkey % 17 = 0 UNION ALL SELECT c_custkey, 'b', '=A1', 'formula' FROM customer WHERE c_custkey % 19 = 0",
    }
