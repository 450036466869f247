"""Sources, sinks, catalog graphs and small operators by worked cases."""

from __future__ import annotations

import re

import pytest
from gaugeworks import register_queries
from gaugeworks.functions import formats, pages
from gaugeworks.operators import indexes, relational, review, vessels
from gaugeworks.plans import catalog, traversal
from gaugeworks.sources import flat
from pyspark.sql import functions as F


def test_tables_of_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    for name in ("b_table", "a_table"):
        spark.range(1).write.mode("overwrite").saveAsTable(f"shelf.{name}")
    spark.range(1).createOrReplaceTempView("passing")
    assert flat.list_tables(spark, "shelf") == ["a_table", "b_table"]
    assert flat.list_tables(spark, "pg_catalog") == []
    kinds = spark.createDataFrame([], "a int, b string, c decimal(5,2)")
    assert flat.describe(kinds) == [("a", "int", True), ("b", "string", True), ("c", "decimal(5,2)", True)]
    assert [flat.table_name(t) for t in (" s.t ", "t", "s.t.u")] == [("s", "t"), ("public", "t"), ("s", "t.u")]


def test_json_lists_are_whole_or_empty(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"a": 1, "b": "x"}, {"b": "y"}]')
    (tmp_path / "bad.json").write_text('[{"a": 1, "b": "x"}, {"a": 2')
    read = lambda name: flat.read_json_list(spark, str(tmp_path / name), "a int, b string")
    assert sorted(map(str, map(tuple, read("good.json").collect()))) == ["(1, 'x')", "(None, 'y')"]
    assert read("bad.json").collect() == [] and read("bad.json").columns == ["a", "b"]
    flat.write_json(read("good.json"), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"a":1,"b":"x"}', '{"a":null,"b":"y"}']


def test_first_full_column_of_a_tolerant_file(spark):
    df = spark.createDataFrame([("", "b", "c"), ("a", "", "c"), (None, " ", None)], "x string, y string, z string")
    assert [r[0] for r in df.select(flat.first_of(df, "w", "x", "y", "z")).collect()] == ["b", "a", None]


def test_flat_exports_have_fixed_columns_a_mark_and_a_count(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "q"), (1, 'a, "b"', "r")], "id int, name string, odd string")
    assert flat.write_flat(df.coalesce(1), str(tmp_path / "out"), ["id"], ["id", "gone", "name"], mark=True) == 2
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    raw = b"".join(f.read_bytes() for f in files)
    assert all(f.read_bytes().startswith(b"\xef\xbb\xbf") for f in files if f.stat().st_size)
    lines = [line for line in raw.decode("utf-8-sig").replace("\ufeff", "").splitlines() if not line.startswith("id,")]
    assert lines == ['1,"","a, ""b"""', '2,"",""'] and raw.decode("utf-8-sig").startswith("id,gone,name")


def test_exports_count_as_they_write_and_leave_a_manifest(spark, tmp_path):
    graph = traversal.Graph(keys={"a": "id", "b": "id", "c": "id"}, links=(traversal.ForeignKey("b", "a_id", "a", "id"), traversal.ForeignKey("c", "a_id", "a", "id")))
    tables = {"a": spark.createDataFrame([(1,), (2,)], "id int"), "b": spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, a_id int"), "c": spark.createDataFrame([(1,)], "id int")}
    said = traversal.export_all(graph.walk("a"), tables, "id = 1", f"file://{tmp_path}")
    assert [e[:4] for e in said] == [("a", 0, "root", 1), ("b", 1, "fk", 2), ("c", 1, "fk", None)] and said[2][4]
    rows = {r["table"]: r for r in spark.read.csv(f"file://{tmp_path}/_manifest", header=True).collect()}
    assert rows["b"].rows == "2" and rows["b"].file == "b" and rows["c"].rows is None and rows["c"].error and rows["c"].file is None


def test_catalog_takes_keys_and_links_of_one_column(spark):
    views = register_queries.information_schema(spark)
    assert sorted(map(tuple, catalog.primary_keys(views["table_constraints"], views["key_column_usage"]).select("table_name", "column_name").collect())) == sorted(register_queries._KEYS.items())
    name = ("public", "pair_fk", "public", "pair")
    more = spark.createDataFrame([(*name, "FOREIGN KEY")], views["table_constraints"].schema)
    two = spark.createDataFrame([(*name, "l", 1, 1), (*name, "n", 2, 2)], views["key_column_usage"].schema)
    refs = spark.createDataFrame([("public", "pair_fk", "public", "lineitem_pk")], views["referential_constraints"].schema)
    table = spark.createDataFrame([("public", "pair"), ("pg_catalog", "part")], views["tables"].schema)
    wide = {v: views[v].unionByName(x) for v, x in zip(catalog.VIEWS, (table, more, two, refs))}
    graph = catalog.graph(wide, reference=("part", "zone", "region"), system=("supplier",))
    assert graph.keys == {**register_queries._KEYS, "lineitem": None, "pair": None}
    assert [(x.table, x.column, x.target, x.target_column) for x in graph.links] == sorted((t, c, to, register_queries._KEYS[to]) for t, c, to in register_queries._LINKS)
    assert graph.reference == {"part", "region"} and catalog.reference_tables(wide["tables"], ()) == []
    assert [s.table for s in graph.walk("nation", 4)] == ["nation", "customer", "orders", "lineitem"]


def test_project_types():
    types = {"Terminal": "7", "Plant": "12"}
    assert traversal.project_type(" terminal", types) == ("7", "") and traversal.project_type("12", types) == ("12", "")
    assert traversal.project_type("99", types)[0] == "99" and traversal.project_type("99", types)[1]
    with pytest.raises(ValueError):
        traversal.project_type("Ship", types)


def test_company_links_and_vessels_alone(spark):
    links = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "unit int, company_id int")
    companies = spark.createDataFrame([(10, "A"), (30, "B")], "company_id int, name string")
    assert [tuple(r) for r in relational.companies_of(links, companies).select("unit", "name").collect()] == [(1, "A")]
    ships = spark.createDataFrame([("One", "FSRU"), ("Two", "carrier"), ("Three", "Import unit"), ("Four", None)], "vessel_name string, vessel_type string")
    hit = spark.createDataFrame([("One",)], "other_name string")
    alone = indexes.unmatched_vessels(ships, hit)
    assert [r.vessel_name for r in alone.collect()] == ["Three"]
    units = spark.createDataFrame([("1", "LNG", "yes", " One ", "x"), ("2", "LNG", "no", "Two", "x"), ("3", "Oil", "yes", "Three", "x")], "unit_id string, fuel string, floating string, vessel_name string, vessel_owner string")
    floating = vessels.floating_units(units)
    assert [(r.unit_id, r.vessel_norm, r.vessel_owner_norm) for r in floating.collect()] == [("1", "one", "x")]
    matched = spark.createDataFrame([("1", "exact"), ("2", "missing"), ("3", "contained")], "unit_id string, how string")
    assert vessels.sync_counts(floating, ships, matched, alone).first().asDict() == {"n_floating": 1, "n_vessels": 4, "n_matched": 2, "n_units_alone": 1, "n_vessels_alone": 1}


def test_corroborated_rows_take_each_unit_once(spark):
    rows = spark.createDataFrame([("m", 1, "Bay Train E", ""), ("m", 2, "Bay", "Train E"), ("m", 3, "Bay Train F", "")], "match string, row int, site string, trains string")
    units = spark.createDataFrame([("m", 1, "Train E", "mothballed"), ("m", 2, "Train F", "operating"), ("m", 3, "", "retired")], "match string, row int, unit_name string, status string")
    assert [tuple(r) for r in vessels.corroborate(rows, units).collect()] == [("m", 1, "Train E")]


def test_lists_of_names_and_parents(spark):
    entries = spark.createDataFrame([([("A", "50"), ("B", None), ("", "10"), (None, "3")],), ([],)], "e array<struct<name:string,share:string>>")
    listed = entries.select(formats.joined(F.transform("e", lambda e: F.struct(e["name"].alias("name"), e.share.cast("decimal(9,3)").alias("share"))))).collect()
    assert listed[0][0].startswith("A [50") and listed[0][0].endswith("; B") and listed[1][0] == ""
    told = spark.range(1).select(formats.whole_shares_with_decimal(F.lit("A [100%]; B [33.5%]")).alias("a"), formats.effective_parents(F.lit("A [33.4%]; B"), F.lit(50)).alias("b"), formats.entity_ids(F.lit("E12, X3; E7")).alias("c")).first()
    assert (told.a, told.b, list(told.c)) == ("A [100.0%]; B [33.5%]", "A [16.7%]; B", [12, 7])


def test_review_sheets(spark):
    units = spark.createDataFrame([("b", "t", "u2", ""), ("a", "t", "u1", "seen"), (None, "t", "u3", None)], "country string, terminal string, unit_name string, mention string")
    assert [(r.country, r.register_only) for r in review.nonoperating_table(units).collect()] == [(None, "only in the register"), ("a", ""), ("b", "only in the register")]
    flagged = spark.createDataFrame([("1", [("old", "high"), ("odd", "low")]), ("2", [])], "unit string, flags array<struct<flag:string,severity:string>>")
    assert sorted((r.unit, r.flag, r.fill) for r in review.stale_table(flagged).collect()) == [("1", "odd", ""), ("1", "old", "yellow")]
    staged = review.staged_table(spark.createDataFrame([(1, "x", "y")], "id int, b string, odd string"), ["b", "gone", "id", "sum"], ("sum",))
    assert staged.columns == ["b", "gone", "id"] and tuple(staged.first()) == ("x", None, 1)


def _anchors(body):
    """Links and the number behind each, by plain steps over the page."""
    out, low, at = [], body.lower(), 0
    while (at := low.find("<a", at)) >= 0:
        at += 2
        end = low.find("</a>", at)
        if body[at : at + 1] not in (">", " ") or end < 0 or ">" not in body[at:end]:
            continue
        name = body[body.index(">", at) + 1 : end]
        behind = re.split("<", body[end + 4 :])[0]
        number = re.search(r"\bimo\W*([0-9]+)\b", behind.lower())
        if "<" not in name and 3 <= len(name) <= 80 and number and len(number[1]) == 7 and number.start() <= 200:
            out.append((name.strip(), number[1]))
    return out


BODIES = [
    "<a href=1>North Star</a> tanker IMO 1234567, <a>South Star</a> IMO:7654321",
    "<A class=x>x</A> IMO 1111111 <a>Ab</a> IMO 2222222 <a>The <b>bold</b> one</a> IMO 3333333",
    "<a>Far one</a>" + " word" * 50 + " IMO 4444444",
    "<a>Near one</a>" + " w" * 95 + " IMO#5555555 IMO 6666666",
    "<abbr>no link</abbr> IMO 7777777 and <a>Cut", "IMO 12345678", "", None, "<a>star</a> imo 8888888<a>Star of the North</a> IMO 9999999",
]


def test_anchors_against_one_expression(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "i int, b string")
    for r in df.select("i", pages.vessel_anchors(F.col("b")).alias("x"), pages.best_anchor(F.col("b"), F.lit("Star")).alias("best")).collect():
        want = _anchors(BODIES[r.i] or "")
        assert [(x["name"], x.number) for x in r.x] == want
        near = [k for n, k in want if "star" in n.lower() or n.lower() in "star"]
        assert r.best.number == (near[0] if near else None)
        assert bool(r.best.warning) == (r.i in (1, 2, 3, 4))
