"""Queries of filters, folds, vessels, formats and review tables over the relational test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import formats, lifecycle, names
from .operators import collapse, filters, relational, review, vessels
from .queries import _pick, _sql_pick, _t

FUELS, FLAGS, NOTES = ["LNG", "oil", "", "LNG"], ["true", "Yes", "1", "no", ""], ["", "Country subtotal 4", "COUNTRY SUBTOTAL", "checked"]
PLACES = ["USA", "U.S.", "united states", "Japan"]
SITES = ["Harbour", "Harbour Expansion", "Bay AB2", "Bay AB3", "Cape Train E", "Cape", "Point III", "Dune T4", "Reef Extension", "Reef"]
FULL = ["harbour", "harbour expansion", "bay ab2", "bay ab3", "cape train e", "cape", "point iii", "dune t4", "reef extension", "reef"]
BASE = ["", "harbour", "bay", "bay", "cape", "", "", "dune", "reef", ""]
RAW = ["", "Harbour", "Bay", "Bay", "Cape", "", "", "Dune", "Reef", ""]
SHIPS = ["Nordic Pearl", "FSRU Coral", "Nordic Pearl FSRU", "Amber LNG", "Jade"]
SHIP_KEYS = ["nordic pearl", "coral", "nordic pearl", "amber", "jade"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row"), (F.col("o_custkey") % 97).alias("match"), "o_custkey", F.floor(F.col("o_totalprice") / 1000).cast("double").alias("capacity"), "o_orderdate")


def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row")
    own = _orders(spark, sf_dir).select("row", "o_custkey", F.when(k % 11 != 0, k % 7 == 0).alias("deleted"), _pick(FUELS, k).alias("fuel"), _pick(FLAGS, k).alias("flag"), _pick(NOTES, k + F.col("o_custkey")).alias("notes"), _pick(PLACES, F.col("o_custkey")).alias("country"))
    few = _t(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    own = filters.without_subtotals(filters.in_scope(filters.not_deleted(filters.of_keys(own, few, "o_custkey"))))
    raw = filters.of_country(own, "USA", normal=False).select("row", F.lit("raw").alias("kind"))
    return filters.of_country(own, "U.S.A.", normal=True).select("row", F.when(filters.is_set(F.col("flag")), "set").otherwise("not set").alias("kind")).unionByName(raw)


def anchor_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row")
    year = lambda start, n: F.when(k % n > 0, (start + k % n).cast("string")).otherwise("")
    years = {"proposal_year": year(1990, 3), "construction_year": year(2000, 4), "shelved_year": year(2010, 5), "cancelled_year": year(2020, 2), "stop_year": year(2030, 7), "actual_start": year(2040, 3)}
    status = _pick([*lifecycle.MOVES, "operating"], k)
    return _orders(spark, sf_dir).select("row", lifecycle.anchor_year(status, years).alias("year"), lifecycle.move_reason(status, _pick(["proposed", "retired", "idled"], F.col("o_custkey"))).alias("reason"))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row")
    own = _orders(spark, sf_dir).filter("row % 3 = 0").select("row", (F.col("o_custkey") % 40).cast("string").alias("country_norm"), F.lit("regasification").alias("section"), _pick(SITES, F.floor(k / 3)).alias("site"), "capacity", _pick(["", "Operating", "mothballed"], k).alias("status"), _pick(["Shell plc 50%, BP", "Total SA", ""], k + F.col("o_custkey")).alias("owner"))
    register = own.filter("site = 'Dune T4' AND country_norm < '2'").select("country_norm", F.lit("dune").alias("name_norm"), "section").distinct()
    alias = own.filter("country_norm > '3'").select("country_norm", F.lit("reef").alias("alias_norm"), "section").distinct()
    return collapse.fold_names(own, register, alias)


def folded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("row", "name_norm", "shown", "folded")


def folded_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.report_projects(_report(spark, sf_dir)).select("country_norm", "name_norm", "capacity", "n_operating", "n_nonoperating", F.array_join("owners", ",").alias("owners"))


_FOLDED = f"""own AS (SELECT o_orderkey AS row, CAST(o_custkey % 40 AS VARCHAR) AS country, {_sql_pick(SITES, '(o_orderkey // 3)')} AS site, {_sql_pick(FULL, '(o_orderkey // 3)')} AS fulln,
    nullif({_sql_pick(BASE, '(o_orderkey // 3)')}, '') AS base, {_sql_pick(RAW, '(o_orderkey // 3)')} AS raw, (o_orderkey // 3) % 10 IN (1, 8) AS stage, floor(o_totalprice / 1000) AS capacity, o_orderkey % 3 AS st, (o_orderkey + o_custkey) % 3 AS ow FROM orders WHERE o_orderkey % 3 = 0),
  known AS (SELECT country, fulln AS name FROM own UNION SELECT country, 'dune' FROM own WHERE site = 'Dune T4' AND country < '2' UNION SELECT country, 'reef' FROM own WHERE country > '3'),
  codes AS (SELECT country, base AS name FROM own WHERE base IN ('bay', 'dune') GROUP BY ALL HAVING count(*) > 1),
  trains AS (SELECT country, base AS name FROM own WHERE base = 'cape' GROUP BY ALL HAVING count(*) > 1),
  f AS (SELECT own.*, base IS NOT NULL AND (EXISTS (SELECT 1 FROM known k WHERE k.country = own.country AND k.name = base) OR (NOT stage AND (EXISTS (SELECT 1 FROM codes c WHERE c.country = own.country AND c.name = base) OR EXISTS (SELECT 1 FROM trains t WHERE t.country = own.country AND t.name = base)))) AS folded FROM own)"""


def _ships(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("row")
    rows = _orders(spark, sf_dir).filter("row % 5 = 0").select("match", "row", F.col("match").cast("string").alias("country_norm"), F.concat(F.lit("port "), (F.floor(k / 5) % 3).cast("string")).alias("name_norm"), F.lit("regasification").alias("section"), F.concat(F.lit("Owner "), _pick(SHIPS, F.floor(k / 5) + F.col("o_custkey"))).alias("vessel_name"), "capacity")
    at = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 97).cast("string").alias("country_norm"), F.concat(F.lit("terminal "), F.col("s_suppkey").cast("string")).alias("name_norm"), F.lit("regasification").alias("section"), F.concat(_pick(SHIPS, F.col("s_suppkey")), F.lit(", "), _pick(SHIPS, F.col("s_suppkey") + 3)).alias("vessel_name"))
    return rows, at


def vessel_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, register = _ships(spark, sf_dir)
    return vessels.route(rows, register).select("row", "name_norm", "register_name")


def vessel_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("match", _pick([*SHIPS, ""], F.col("row")).alias("vessel_name"), "capacity")
    units = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 97).alias("match"), _pick(SHIPS, F.col("s_suppkey")).alias("unit_name"), _pick(["operating", "retired", "Operating"], F.col("s_suppkey")).alias("status"))
    return vessels.operating_capacity(rows, units)


def nonoperating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row")
    rows = _orders(spark, sf_dir).select("match", "row", _pick(SITES, k).alias("site"), _pick(["", "T1", "T2-3"], k).alias("trains"), _pick(["operating", "Mothballed", "idled", "shelved"], k).alias("status"), F.col("capacity").cast("long").alias("capacity"), F.when(k % 9 == 0, "p. 4").alias("prose"))
    return vessels.nonoperating_lines(rows)


def fuel_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.struct("l_linenumber", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linestatus")).alias("category"), F.when(F.col("l_linenumber") % 2 > 0, F.col("l_returnflag")).alias("detail"), F.when(F.col("l_quantity") > 5, F.when(F.col("l_quantity") > 40, 100).otherwise(F.col("l_quantity"))).cast("decimal(10,2)").alias("share"))
    lists = relational.grouped_lists(_t(spark, sf_dir, "lineitem").select("l_orderkey", one.alias("e")), "l_orderkey", ["e"], [], "e")
    return lists.select("l_orderkey", formats.fuels(F.transform("e", lambda x: x.e)).alias("fuels"))


def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _orders(spark, sf_dir).select(F.col("row").alias("unit_id"), F.col("o_custkey").alias("plant_id"), _pick(["", "here"], F.col("row")).alias("place"), "capacity")
    plants = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("plant_id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("place"))
    both = {"unit_id": ("unit_id", None), "name": (None, "name"), "place": ("place", "place")}
    first = relational.compose(units, plants, "plant_id", both, limit=500, order=["name"])
    second = relational.compose(units, plants, "plant_id", {"unit_id": ("unit_id", None), "plant_place": ("place", "place")}, unit_first=False)
    return first.join(second, "unit_id")


def unit_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("unit"), (F.col("s_suppkey") % 5 == 0).alias("converted"), F.when(F.col("s_suppkey") % 10 == 0, F.floor(F.col("s_suppkey") / 2)).alias("converted_from"))
    old = own.filter("unit % 7 = 0").select("unit", F.explode(F.array(F.floor(F.col("unit") / 7), F.lit(None).cast("long"), F.floor(F.col("unit") / 3))).alias("replaces"))
    return relational.conversions(own, old)


def parent_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("A [E"), (F.col("c_custkey") % 30).cast("string"), F.lit("]; B [E"), (F.col("c_custkey") % 7).cast("string"), F.lit("]"))
    own = _t(spark, sf_dir, "customer").select("c_custkey", text.alias("parents"))
    homes = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("country"))
    return relational.parent_homes(own, "c_custkey", "parents", homes, formats.entity_ids(F.col("parents")))


def company_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling, alone and in longer names."""
    spelled = list(names.ENTITY_OF)
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, _pick(spelled, k)).when(k % 3 == 1, F.concat(F.lit("The "), F.initcap(_pick(spelled, k)), F.lit("  of "), _pick(spelled, k * 7), F.lit(" (old)."))).otherwise(F.concat(_pick(spelled, k), F.lit("x ltd")))
    own = _t(spark, sf_dir, "customer").select("c_custkey", text.alias("raw"))
    return own.join(names.entities(own), "raw").select("c_custkey", "entity")


def country_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _t(spark, sf_dir, "customer").select("c_custkey", names.country(F.concat(F.lit(" "), F.upper(_pick(list(names.COUNTRY_OF), k)), F.when(k % 2 == 0, " (new)").otherwise("."))).alias("country"))


def review_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _orders(spark, sf_dir)
    matches = own.filter("row % 4 = 0").select(F.col("row").alias("match"), _pick(["Harbour", "Bay (old)"], F.col("row") / 4).alias("site"), _pick(["", "Jade"], F.col("o_custkey")).alias("vessel"), F.col("capacity").alias("report_capacity"), (F.col("o_custkey") % 150).cast("double").alias("register_capacity"), (F.col("row") % 3 > 0).alias("disagrees"))
    units = own.filter("row % 16 = 0").select(F.col("row").alias("match"), F.lit("Unit site").alias("site"), F.lit("U1").alias("register_unit"), F.col("capacity").alias("report_capacity"), F.lit(100.0).alias("register_capacity"), (F.col("row") % 3 == 0).alias("agrees"))
    return review.operating_table(matches, units).withColumn("delta", F.round("delta", 2))


def action_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _orders(spark, sf_dir).select((F.col("o_custkey") % 25).cast("string").alias("country"), F.col("row").cast("string").alias("site"), F.concat(F.lit("n"), (F.col("row") % 5).cast("string")).alias("note"))
    parts = {name: own.filter(F.col("note") == f"n{i}") for i, name in enumerate(review.ACTIONS)}
    return review.action_list(parts).drop("todo")


def candidate_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _orders(spark, sf_dir).select(F.col("row").alias("unit_id"), F.col("o_custkey").alias("terminal_id"))
    lines = _t(spark, sf_dir, "customer").filter("c_custkey % 4 > 0").select(F.col("c_custkey").alias("terminal_id"), F.explode(F.sequence(F.lit(1), (F.col("c_custkey") % 4).cast("int"))).alias("rank"))
    findings = lines.withColumn("kind", _pick(["fuzzy", "ambiguous", "disagreement"], F.col("terminal_id") + F.col("rank"))).withColumn("text", F.col("rank").cast("string"))
    return review.candidate_edits(units, findings)


_NAMES = [row_filters, anchor_years, folded_names, folded_projects, vessel_routes, vessel_capacity, nonoperating_rows, fuel_lists, unit_rows, unit_conversions, parent_countries, company_tags, country_spellings, review_tables, action_list, candidate_edits]


def queries() -> dict:
    return {f.__name__: f for f in _NAMES}


def _table(rows: list[tuple], columns: str) -> str:
    q = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(q, r)) + ')' for r in rows)}) AS t({columns})"


def oracle_sql() -> dict[str, str]:
    statuses = [*lifecycle.MOVES, "operating"]
    year = lambda start, n: f"CASE WHEN o_orderkey % {n} > 0 THEN CAST({start} + o_orderkey % {n} AS VARCHAR) END"
    moves = _table([(a, b) for a, v in lifecycle.MOVES.items() for b in v.split()], "a, b")
    spelled = list(names.ENTITY_OF)
    tags = _table([(s, names.ENTITY_OF[s], i) for i, s in enumerate(names._BY_LENGTH)], "spelling, tag, rank")
    ships = lambda k: _sql_pick(SHIP_KEYS, k)
    return {
        "row_filters": f"""WITH b AS (SELECT o_orderkey AS row, {_sql_pick(PLACES, 'o_custkey')} AS country, {_sql_pick(FLAGS, 'o_orderkey')} AS flag FROM orders
            WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 4 IN (0, 3) AND (o_orderkey + o_custkey) % 4 IN (0, 3))
            SELECT row, CASE WHEN lower(flag) IN ('true', 'yes', '1') THEN 'set' ELSE 'not set' END AS kind FROM b WHERE country <> 'Japan' UNION ALL SELECT row, 'raw' FROM b WHERE country = 'USA'""",
        "anchor_years": f"""WITH m AS (SELECT * FROM {moves}), o AS (SELECT o_orderkey AS row, {_sql_pick(statuses, 'o_orderkey')} AS s, {_sql_pick(['proposed', 'retired', 'idled'], 'o_custkey')} AS n, {year(1990, 3)} AS p, {year(2000, 4)} AS c, {year(2010, 5)} AS h, {year(2020, 2)} AS x, {year(2030, 7)} AS e, {year(2040, 3)} AS a FROM orders),
            l AS (SELECT k AS s, v AS told FROM {_table([(k, ', '.join(v.split()) or 'none') for k, v in lifecycle.MOVES.items()], 'k, v')})
            SELECT row, coalesce(CASE s WHEN 'proposed' THEN p WHEN 'construction' THEN coalesce(c, p) WHEN 'shelved' THEN h WHEN 'cancelled' THEN coalesce(x, h) WHEN 'operating' THEN NULL ELSE coalesce(e, a) END, '') AS year,
            CASE WHEN s = n THEN 'unchanged' WHEN EXISTS (SELECT 1 FROM m WHERE m.a = s AND m.b = n) THEN 'legal' ELSE s || ' may lead to: ' || told END AS reason FROM o JOIN l USING (s)""",
        "folded_names": f"WITH {_FOLDED} SELECT row, CASE WHEN folded THEN base ELSE fulln END AS name_norm, CASE WHEN folded THEN raw ELSE site END AS shown, folded FROM f",
        "folded_projects": f"""WITH {_FOLDED}, g AS (SELECT country AS country_norm, CASE WHEN folded THEN base ELSE fulln END AS name_norm, * FROM f),
            t AS (SELECT country_norm, name_norm, coalesce(sum(capacity) FILTER (st <> 2), 0) AS capacity, count(*) FILTER (st <> 2) AS n_operating, count(*) FILTER (st = 2) AS n_nonoperating, bool_or(ow = 0) AS a, bool_or(ow = 1) AS b FROM g GROUP BY ALL)
            SELECT country_norm, name_norm, capacity, n_operating, n_nonoperating, array_to_string(list_filter([CASE WHEN a THEN 'bp' END, CASE WHEN a THEN 'shell' END, CASE WHEN b THEN 'totalenergies' END], lambda x: x IS NOT NULL), ',') AS owners FROM t""",
        "vessel_routes": f"""WITH r AS (SELECT o_orderkey AS row, CAST(o_custkey % 97 AS VARCHAR) AS c, 'port ' || CAST(o_orderkey // 5 % 3 AS VARCHAR) AS n, {ships('(o_orderkey // 5 + o_custkey)')} AS v FROM orders WHERE o_orderkey % 5 = 0),
            w AS (SELECT CAST(s_suppkey % 97 AS VARCHAR) AS c, 'terminal ' || CAST(s_suppkey AS VARCHAR) AS t, unnest([{ships('s_suppkey')}, {ships('(s_suppkey + 3)')}]) AS v FROM supplier),
            l AS (SELECT r.row, r.c, r.n, min(w.t) AS t FROM r LEFT JOIN w ON w.c = r.c AND w.v = r.v GROUP BY ALL),
            g AS (SELECT c, n FROM l GROUP BY ALL HAVING count(*) >= 2 AND count(*) = count(t) AND count(DISTINCT t) >= 2)
            SELECT row, CASE WHEN g.c IS NULL THEN l.n ELSE l.n || ' ## ' || t END AS name_norm, CASE WHEN g.c IS NOT NULL THEN t END AS register_name FROM l LEFT JOIN g ON g.c = l.c AND g.n = l.n""",
        "vessel_capacity": f"""WITH w AS (SELECT DISTINCT s_suppkey % 97 AS match, {ships('s_suppkey')} AS v FROM supplier WHERE s_suppkey % 3 <> 1),
            r AS (SELECT o_custkey % 97 AS match, {_sql_pick([*SHIP_KEYS, ''], 'o_orderkey')} AS v, floor(o_totalprice / 1000) AS c FROM orders),
            j AS (SELECT r.*, w.v IS NOT NULL AS works FROM r LEFT JOIN w ON w.match = r.match AND w.v = r.v),
            g AS (SELECT match, count(*) FILTER (v <> '') AS nv, count(*) FILTER (works) AS n, coalesce(sum(c) FILTER (works OR v = ''), 0) AS cap, coalesce(sum(c) FILTER (v <> '' AND NOT works), 0) AS ex FROM j GROUP BY match)
            SELECT match, n > 0 AS applied, CASE WHEN n > 0 THEN cap ELSE 0 END AS capacity, n AS n_operating, CASE WHEN n > 0 THEN ex ELSE 0 END AS excluded FROM g WHERE nv >= 2""",
        "nonoperating_rows": f"""SELECT o_custkey % 97 AS match, o_orderkey AS row, {_sql_pick(SITES, 'o_orderkey')} || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' T1' ELSE ' T2-3' END || ' (' || {_sql_pick(['operating', 'Mothballed', 'idled', 'shelved'], 'o_orderkey')} || ', ' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ')' || CASE WHEN o_orderkey % 9 = 0 THEN ' [report''s text: p. 4]' ELSE '' END AS line FROM orders WHERE o_orderkey % 4 > 0""",
        "fuel_lists": """WITH e AS (SELECT l_orderkey, l_linenumber AS n, CASE WHEN l_linenumber % 3 > 0 THEN l_linestatus ELSE '' END AS c, CASE WHEN l_linenumber % 2 > 0 THEN l_returnflag ELSE '' END AS d, CASE WHEN l_quantity > 5 AND l_quantity <= 40 THEN ' [' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '%]' ELSE '' END AS s, CASE WHEN l_quantity > 40 THEN 100 WHEN l_quantity > 5 THEN l_quantity END AS q FROM lineitem)
            SELECT l_orderkey, coalesce(string_agg(CASE WHEN c <> '' THEN c || ': ' || d ELSE d END || s, ', ' ORDER BY n, c, d, q NULLS FIRST) FILTER (c <> '' OR d <> ''), '') AS fuels FROM e GROUP BY l_orderkey""",
        "unit_rows": """WITH p AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS place FROM customer), few AS (SELECT * FROM p ORDER BY c_name LIMIT 500)
            SELECT CAST(o_orderkey AS VARCHAR) AS unit_id, few.c_name AS name, CASE WHEN o_orderkey % 2 = 1 THEN 'here' ELSE few.place END AS place, CASE WHEN few.place <> '' THEN few.place WHEN o_orderkey % 2 = 1 THEN 'here' ELSE '' END AS plant_place FROM orders JOIN few ON o_custkey = c_custkey""",
        "unit_conversions": """WITH u AS (SELECT s_suppkey AS unit, CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey // 2 END AS src FROM supplier),
            r AS (SELECT unit, unnest([unit // 7, unit // 3]) AS old FROM u WHERE unit % 7 = 0),
            b AS (SELECT unit, string_agg('G' || old, ', ' ORDER BY old) AS olds FROM r GROUP BY unit),
            l AS (SELECT old AS unit, unit AS nxt FROM r UNION ALL SELECT src, unit FROM u WHERE src IS NOT NULL), a AS (SELECT unit, string_agg('G' || nxt, ', ' ORDER BY nxt) AS nxts FROM l GROUP BY unit)
            SELECT u.unit, CASE WHEN src IS NOT NULL THEN 'conversion' WHEN olds IS NOT NULL THEN 'replacement' ELSE '' END AS kind, coalesce('G' || src, olds, '') AS from_ids, coalesce(nxts, '') AS to_ids FROM u LEFT JOIN b USING (unit) LEFT JOIN a USING (unit)""",
        "parent_countries": "SELECT c_custkey, coalesce(a.n_name || '; ', '') || b.n_name AS homes FROM customer LEFT JOIN nation a ON a.n_nationkey = c_custkey % 30 JOIN nation b ON b.n_nationkey = c_custkey % 7",
        "company_tags": f"""WITH s AS MATERIALIZED (SELECT * FROM {tags}), k AS (SELECT *, row_number() OVER (ORDER BY i) - 1 AS pos FROM {_table(list(enumerate(spelled)), 'i, v')}),
            c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN x.v WHEN 1 THEN 'the ' || x.v || ' of ' || y.v ELSE x.v || 'x ltd' END AS base FROM customer JOIN k x ON x.i = c_custkey % {len(spelled)} JOIN k y ON y.i = c_custkey * 7 % {len(spelled)}),
            h AS (SELECT c_custkey, arg_min(tag, rank) AS tag FROM c JOIN s ON contains(' ' || base || ' ', ' ' || spelling || ' ') GROUP BY c_custkey)
            SELECT c_custkey, coalesce(tag, base) AS entity FROM c LEFT JOIN h USING (c_custkey)""",
        "country_spellings": f"""WITH t AS (SELECT * FROM {_table([(i, k, v) for i, (k, v) in enumerate(names.COUNTRY_OF.items())], 'i, k, v')}), b AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN regexp_replace(k, '\\.+$', '') ELSE regexp_replace(k || '.', '\\.+$', '') END AS base FROM customer JOIN t ON i = c_custkey % {len(names.COUNTRY_OF)})
            SELECT c_custkey, coalesce(t.v, base) AS country FROM b LEFT JOIN t ON t.k = base""",
        "review_tables": """WITH o AS (SELECT o_orderkey AS match, o_custkey AS cust, floor(o_totalprice / 1000) AS cap FROM orders),
            m AS (SELECT match, 'project' AS level, CASE WHEN match // 4 % 2 = 0 THEN 'Harbour' || CASE WHEN cust % 2 = 1 THEN ' (Jade)' ELSE '' END ELSE 'Bay (old)' END AS site, '' AS register_unit, cap AS report_capacity, CAST(cust % 150 AS DOUBLE) AS register_capacity, match % 3 > 0 AS bad FROM o WHERE match % 4 = 0
              UNION ALL SELECT match, 'unit', 'Unit site', 'U1', cap, 100.0, match % 3 > 0 FROM o WHERE match % 16 = 0)
            SELECT match, level, site, register_unit, report_capacity, register_capacity, report_capacity - register_capacity AS delta,
              CASE WHEN NOT bad OR report_capacity = register_capacity THEN '' WHEN register_capacity = 0 OR abs(report_capacity - register_capacity) / register_capacity * 100 >= 5 THEN 'dark' ELSE 'light' END AS fill FROM m""",
        "action_list": f"SELECT CAST(o_orderkey % 5 AS INTEGER) AS part, {_sql_pick(list(review.ACTIONS), 'o_orderkey')} AS action, CAST(o_custkey % 25 AS VARCHAR) AS country, CAST(o_orderkey AS VARCHAR) AS site, 'n' || CAST(o_orderkey % 5 AS VARCHAR) AS note FROM orders",
        "candidate_edits": f"""WITH l AS (SELECT c_custkey AS t, unnest(range(1, c_custkey % 4 + 1)) AS r FROM customer WHERE c_custkey % 4 > 0), f AS (SELECT t, r, {_sql_pick(['fuzzy', 'ambiguous', 'disagreement'], '(t + r)')} AS k FROM l),
            g AS (SELECT t, arg_min(k, r) AS kind, string_agg(k || ': ' || CAST(r AS VARCHAR), '; ' ORDER BY r) AS summary FROM f GROUP BY t)
            SELECT o_custkey AS terminal_id, o_orderkey AS unit_id, kind, summary FROM orders JOIN g ON t = o_custkey""",
    }
