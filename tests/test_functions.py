"""Column functions against worked examples."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from gaugeworks.functions import capacity, formats, lifecycle, names, pages
from pyspark.sql import functions as F


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", bool: "boolean", Decimal: "decimal(20,6)", date: "date", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)] if not isinstance(v, list) else 'array<string>'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "site"), [("Sabine Pass LNG Terminal", "sabine pass"), ("Cedar FLNG Terminal", "cedar"), ("Stade FSRU", "stade"), ("Gibbstown Deepwater Port LNG Terminal", "gibbstown"), ("Prelude (FLNG)", "prelude"), ("LNG Canada Terminal", "canada"), ("X Terminal FSRU", "x terminal"), (None, "")])
def test_sites(spark, name, site):
    assert one(spark, names.site(F.col("a")), a=name) == site


def test_countries_and_entities(spark):
    country = lambda x: one(spark, names.country(F.col("a")), a=x)
    entity = lambda x: one(spark, names.entity(F.col("a")), a=x)
    assert [country(x) for x in ("USA", "Korea, South", " u.s.a. ", "Turkey (x)", "Narnia", None)] == ["united states", "south korea", "united states", "türkiye", "narnia", ""]
    assert [entity(x) for x in ("Royal Dutch Shell", "Shell International", "Venture Global LNG Inc", "My Total Friend", "Shellfish", None)] == ["shell", "shell", "venture-global", "totalenergies", "shellfish", ""]
    found = one(spark, names.entity_list(F.col("a")), a="ENI 50%, EGAS 40%; EGPC [10.5%], Shell")
    assert [(x.entity, x.pct) for x in found] == [("eni", 50.0), ("egas", 40.0), ("egpc", 10.5), ("shell", None)]
    cases = {
        names.without_unit_code: [("Harbour AB2C", "Harbour"), ("Old Harbour T3", "Old Harbour"), ("Harbour 2B", None), ("Harbour III", None), ("AB2C", None)],
        names.without_train: [("Harbour Train B", "Harbour"), ("Harbour trains 12", "Harbour"), ("Harbour Train XLIV", "Harbour"), ("Night Train Depot", None), ("Train 4", None)],
        names.without_expansion: [("Harbour Expansion", "Harbour"), ("Harbour  EXTENSION ", "Harbour"), ("Harbour Expansion 2", None), ("Expansion", None)],
    }
    for strip, pairs in cases.items():
        for name, want in pairs:
            assert one(spark, strip(F.col("a")), a=name) == want, (name, want)
    rows = spark.createDataFrame([(x,) for x in [*names.ENTITY_OF, "Big Shell plc Trading", "x total y bp plc", "nobody", None, "", "Total  Energies (new)", "petronet lng ltd"]], "raw string")
    by_join = {r.raw: r.entity for r in names.entities(rows).collect()}
    assert by_join == {r.raw: r.e for r in rows.select("raw", names.entity(F.col("raw")).alias("e")).collect()}
    assert one(spark, names.designators(F.col("a")), a="QatarEnergy LNG S(2)") == ["s2"] and one(spark, names.designators(F.col("a")), a="Sabine Pass") == []
    assert one(spark, names.tokens(F.col("a"), 4), a="Tianjin-Nangang (LNG), pier") == ["tianjin", "nangang", "pier"]


@pytest.mark.parametrize(("text", "lo", "hi", "unit"), [("3 mt/y", 3.0, 3.0, "mt/y"), ("0.75 to 1.25 bcf/d", 0.75, 1.25, "bcf/d"), (" 11-12.5 mtpa a year", 11.0, 12.5, "mtpa"), ("8–9 BCM/Y", 8.0, 9.0, "bcm/y"), ("Circa 4.5mtpa", 4.5, 4.5, "mtpa"), ("around ~ 2 - 3 mtpa", 2.0, 3.0, "mtpa"), ("6 tpa to 7 tpa", 6.0, 6.0, "tpa")])
def test_ranges(spark, text, lo, hi, unit):
    r = one(spark, capacity.parse_range(F.col("a")), a=text)
    assert (r.lo, r.hi, r.unit) == (lo, hi, unit)


def test_capacities(spark):
    shown = lambda v, u: one(spark, capacity.rendered_mtpa(F.col("a"), F.col("b")), a=v, b=u)
    assert shown(Decimal("1"), "bcf/d") == Decimal("7.67") and shown(Decimal("150"), "MMcf/d") == Decimal("1.15") and shown(Decimal("1"), "ounces") is None
    assert one(spark, capacity.to_mtpa(F.col("a"), F.col("b")), a="1.36", b="bcm/y") == pytest.approx(1.0)
    assert one(spark, capacity.to_mtpa(F.col("a"), F.col("b")), a="many", b="mtpa") is None
    for text in ("nothing", "", "1.2.3 mtpa", "mtpa 5", "7", ".5 mtpa"):
        assert one(spark, capacity.parse_range(F.col("a")), a=text) is None, text


def test_formats(spark):
    d = lambda f, x: one(spark, f(F.col("a")), a=Decimal(x))
    assert [d(formats.at_least_one_decimal, x) for x in ("20000000000", "2.15", "2.00", "9.5")] == ["20000000000.0", "2.15", "2.0", "9.5"]
    assert d(formats.fixed2, "9.5") == "9.50" and d(formats.number, "100") == "100" and d(formats.number, "12.50") == "12.5"
    assert [d(formats.owner_share, "100"), d(formats.owner_share, "50.5"), d(formats.owner_share_whole, "33.5"), d(formats.parent_share, "65"), d(formats.parent_share, "41.32")] == ["100%", "50.5%", "34%", "65.0%", "41.32%"]
    assert one(spark, formats.whole_shares_with_decimal(F.col("a")), a="A [100%]; B [41.32%]") == "A [100.0%]; B [41.32%]"
    assert one(spark, formats.effective_parents(F.col("a"), F.col("b")), a="A [50%]; B [33.33%]; C", b=Decimal("50")) == "A [25.0%]; B [16.7%]; C"
    assert one(spark, formats.entity_ids(F.col("a")), a="E12 [5%]; E7") == [12, 7]
    assert one(spark, formats.latest_activity(F.col("a"), F.col("b"), F.col("c").cast("int")), a=2024, b=5, c=None) == "Year: 2024, Month: 5"


LINE = "array<struct<order:int,status:string,substatus:string,year:int,month:string,refs:array<bigint>>>"


def test_timeline(spark):
    rows = [(6, "operating", "planned", 2027, None, [6]), (1, "proposed", "", None, None, [1]), (2, "proposed", None, 2018, "3", [2]), (3, "FID", "actual", 2020, None, None), (4, "construction", "actual", 2021, None, [4]), (5, "operating", "planned", 2025, None, [5])]
    df = spark.createDataFrame([(rows,), ([],)], f"t {LINE}")
    a = [r.a for r in df.select(lifecycle.anchors(F.col("t")).alias("a")).collect()]
    assert (a[0].status, a[0].proposal_year, a[0].construction_year, a[0].original_planned_start, a[0].latest_planned_start, a[0].fid_status, a[0].start_refs) == ("construction", "2018", "2021", "2025", "2027", "FID", [5, 6])
    assert a[1].status == "" and a[1].start_refs == []
    only = spark.createDataFrame([([(1, "FID", "planned", 2020, None, None)],)], f"t {LINE}")
    assert only.select(lifecycle.current(F.col("t")).status.alias("a"), lifecycle.current_strict(F.col("t")).alias("b")).first() == ("FID", "")


def test_rules(spark):
    legal = lambda a, b: one(spark, lifecycle.legal_move(F.col("a"), F.col("b")), a=a, b=b)
    assert legal("proposed", "construction") and legal("cancelled", "proposed") and legal("retired", "retired")
    assert not legal("retired", "operating") and not legal("x", "operating")
    warn = lambda s, b, y: one(spark, lifecycle.entry_warnings(F.col("a"), F.col("b"), F.col("c")), a=s, b=b, c=y)
    assert warn("shelved", "planned", "1900") == ["substatus_not_of_status", "year_out_of_range"] and warn("operating", "actual", "2001") == []
    days = [one(spark, lifecycle.parse_date(F.col("a")), a=x) for x in ("2024-05-01", "05/02/2024", "2024/05/03", "31/12/2024", "2024-06", "2024", "soon", "")]
    assert days == [date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 3), date(2024, 12, 31), date(2024, 6, 1), date(2024, 1, 1), None, None]
    flags = one(spark, lifecycle.stale_flags(F.col("a"), F.col("b"), F.col("c"), F.lit("2026-01-01").cast("date")), a="proposed", b=date(2023, 1, 1), c="2020")
    assert [f.flag for f in flags] == ["inferred_shelved_candidate", "planned_start_slipped"]


def test_pages(spark):
    ok = lambda s, b, e: tuple(one(spark, pages.verify(F.col("a"), F.col("b"), F.col("c")), a=s, b=b, c=e))
    assert ok("200", "<title>Fine</title> Cheniere", ["cheniere"]) == (True, "OK")
    assert ok("404", "", []) == (False, "HTTP 404") and ok("200", "<TITLE>Sign In</TITLE>x", ["x"])[1] == "soft-error page" and not ok("200", "a", ["a", "b"])[0]
    form = '<input name="f-0-status" value="proposed"><input name="f-0-year" value="2020"><input name="f-1-status" value="Operating">'
    found = one(spark, pages.form_timeline(F.col("a")), a=form)
    assert [(x["index"], x.status, x.year) for x in found] == [(0, "proposed", "2020"), (1, "Operating", None)]
    assert one(spark, pages.vessel_numbers(F.col("a")), a="IMO 1234567, imo#7654321, IMO 12") == ["1234567", "7654321"]
    assert [x.id for x in one(spark, pages.linked_entities(F.col("a")), a='<a href="/entities/5/">A</a><a href="/x">B</a>')] == ["5"]
