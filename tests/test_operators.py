"""Operators on small tables, and every query against its SQL."""

from __future__ import annotations

import os
import random

import duckdb
import pandas as pd
import pytest
from gaugeworks import queries
from gaugeworks.operators import indexes, reconcile, relational
from gaugeworks.plans import traversal
from gaugeworks.sources import flat
from gaugeworks.streaming import latest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def table(df: pd.DataFrame):
    plain = lambda v: None if v is None or v is pd.NA or v is pd.NaT or v != v else round(v, 6) if isinstance(v, float) else v.item() if hasattr(v, "item") else v
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, sql, name):
    got, want = queries.queries()[name](spark, SMALL).toPandas(), sql.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def side(spark, rows):
    return spark.createDataFrame(rows, "country_norm string, name_norm string, section string, capacity double, owners array<string>")


def test_reconciliation_passes(spark):
    report = side(spark, [("a", "alpha", "l", 5.0, ["x"]), ("a", "old beta", "l", 2.0, []), ("a", "gamma harbour", "l", 1.0, ["y"]), ("a", "delta", "l", 1.0, []), ("b", "twin port", "l", 1.0, ["z"]), ("a", "forced", "l", 1.0, [])])
    register = side(spark, [("a", "alpha", "l", 4.0, ["x", "w"]), ("a", "beta", "l", 2.0, []), ("a", "gamma", "l", 1.0, ["y"]), ("b", "twin port east", "l", 1.0, []), ("b", "twin port west", "l", 1.0, []), ("a", "epsilon", "l", 9.0, []), ("a", "target", "l", 1.0, [])])
    alias = spark.createDataFrame([("a", "old beta", "l", "beta")], "country_norm string, alias_norm string, section string, register_name string")
    forced = spark.createDataFrame([("a", "forced", "l", "target")], "country_norm string, name_norm string, section string, register_name string")
    out = {(r.name_norm, r.how): r.register_name for r in reconcile.reconcile(report, register, alias, forced).collect()}
    assert out == {("alpha", "exact"): "alpha", ("old beta", "alias"): "beta", ("gamma harbour", "fuzzy"): "gamma", ("delta", "report_only"): None, ("twin port", "ambiguous"): None, ("forced", "forced"): "target", ("epsilon", "register_only"): "epsilon", ("twin port east", "register_only"): "twin port east", ("twin port west", "register_only"): "twin port west"}
    matches = reconcile.reconcile(report, register, alias, forced)
    diffs = {r.name_norm: r for r in reconcile.differences(matches, report, register).collect()}
    assert diffs["alpha"].delta == 1.0 and diffs["alpha"].delta_pct == 25.0 and diffs["alpha"].material and diffs["alpha"].register_only_owners == ["w"]
    gate = reconcile.gates(matches, reconcile.differences(matches, report, register)).first()
    assert (gate.exact, gate.fuzzy, gate.ambiguous, gate.report_only, gate.matched) == (1, 1, 1, 1, 4)


def test_greedy_assignment_does_not_hang_on_row_order(spark):
    rows = [("a", f"n{i}", "l", f"r{j}", True, 0, False, i == j) for i in range(6) for j in range(i, 6)]
    kinds = "country_norm string, name_norm string, section string, register_name string, inside boolean, shared int, owner_overlap boolean, owner_named boolean"
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        results.append(sorted(map(tuple, reconcile.assign_greedily(spark.createDataFrame(rows, kinds)).collect())))
    assert results[0] == results[1] == results[2] and [r[3] for r in results[0]] == [f"r{i}" for i in range(6)]


def _in_turn(keys, candidates, named):
    """The rule, key by key: (how, taken) for each that has a candidate left."""
    out, taken = {}, {}
    for place, name, section in sorted(keys, key=lambda k: (k[0], k[2], k[1])):
        mine = taken.setdefault((place, section), set())
        left = [r for r in candidates[place, name, section] if r not in mine]
        by_owner = [r for r in left if (name, r) in named[place, section]]
        if len(left) > 1 and len(by_owner) == 1:
            left = by_owner
        if len(left) == 1:
            mine.add(left[0])
        if left:
            out[place, name, section] = (left[0], "fuzzy") if len(left) == 1 else (None, "ambiguous")
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rounds_of_matching_are_the_rule_in_turn(spark, seed):
    pick = random.Random(seed)
    keys = [(f"c{i % 3}", f"n{i:03d}", "ls"[i % 2]) for i in range(90)]
    candidates = {k: sorted({f"r{pick.randrange(3 + int(k[1][1:]) // 4)}" for _ in range(pick.choice([0, 1, 1, 2, 2, 3]))}) for k in keys}
    named = {(p, s): {(n, r) for (q, n, t), c in candidates.items() if (q, t) == (p, s) for r in c if pick.random() < 0.15 * seed} for p, _, s in keys}
    rows = [(*k, r, True, 0, False, (k[1], r) in named[k[0], k[2]] or pick.choice([False, None])) for k, c in candidates.items() for r in c]
    pick.shuffle(rows)
    kinds = "country_norm string, name_norm string, section string, register_name string, inside boolean, shared int, owner_overlap boolean, owner_named boolean"
    got = {(r.country_norm, r.name_norm, r.section): (r.register_name, r.how) for r in reconcile.assign_greedily(spark.createDataFrame(rows, kinds)).collect()}
    assert got == _in_turn(keys, candidates, named)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_matching_by_counts_is_the_rule_over_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(reconcile, "FREQUENT", 2)
    pick = random.Random(seed)
    word, owner = ["harbour", "terminal", "north", "isle", "stone"], ["o1", "o2", "o3"]
    name = lambda i: " ".join(dict.fromkeys([pick.choice(word), f"x{i}", *pick.sample(word, pick.choice([0, 0, 1]))]))
    report = [("a", name(i), "l", [pick.choice(owner)]) for i in range(40)] + [("a", "stone", "l", []), ("a", "x1", "l", []), ("b", "north x1", "l", ["o1"])]
    register = [("a", name(100 + i), "l", pick.sample(owner, 2), pick.choice([None, None, None, "o1", "o2"])) for i in range(pick.choice([8, 45]))] + [("b", "north x1 quay", "l", [], None)]
    report, register = list({r[:3]: r for r in report}.values()), list({r[:3]: r for r in register}.values())
    words = lambda t: {w for w in t.split() if len(w) >= 4}
    candidates, named = {}, {}
    for p, n, s, o in report:
        near = lambda r: n in r[1] or r[1] in n or (words(n) & words(r[1]) and set(o) & set(r[3])) or len(words(n) & words(r[1])) >= 2  # noqa: B023, E731
        candidates[p, n, s] = sorted(r[1] for r in register if r[0] == p and near(r))
        named.setdefault((p, s), set()).update((n, r[1]) for r in register if r[0] == p and o and r[4] == o[0])
    a = spark.createDataFrame(report, "country_norm string, name_norm string, section string, owners array<string>")
    b = spark.createDataFrame(register, "country_norm string, name_norm string, section string, owners array<string>, bracket_owner string")
    pairs, many = reconcile.fuzzy_pairs(a, b)
    got = {(r.country_norm, r.name_norm, r.section): (r.register_name, r.how) for r in reconcile.assign_greedily(pairs, many).collect()}
    assert got == _in_turn([r[:3] for r in report], candidates, named)
    assert pairs.count() <= sum(map(len, candidates.values())) and (seed % 2 or many.count() >= 0)


def test_containments_go_by_the_rarest_stretch(spark):
    pick = random.Random(4)
    texts = ["port of " + "".join(pick.choice("abc") for _ in range(pick.randint(0, 6))) for _ in range(60)] + ["port", "", "of", None, "a"]
    a = spark.createDataFrame([("p", t) for t in texts], "place string, inner string")
    b = spark.createDataFrame([("p", t) for t in texts[::2]] + [("q", "port")], "place string, outer string")
    got = sorted((r.inner, r.outer) for r in relational.containments(a.distinct(), b.distinct(), ["place"], "inner", "outer").collect())
    assert got == sorted((x, y) for x in set(texts) for y in set(texts[::2]) if x and y and x in y)


def test_running_sums_over_a_total_order(spark):
    rows = [(f"k{i * 7 % 100:02d}", i) for i in range(100)]
    got = {r.k: r.before for r in relational.running_sum(spark.createDataFrame(rows, "k string, v long"), ["k"], "v", "before").collect()}
    at = 0
    for k, v in sorted(rows):
        assert got[k] == at
        at += v


def test_designators_stand_for_one_unit(spark):
    report = spark.createDataFrame([("q", "big energy s(2)", "l", ["o"]), ("q", "other n(9)", "l", [])], "country_norm string, name_norm string, section string, owners array<string>")
    units = spark.createDataFrame([("q", "big energy south", "l", "Train S(2)", ["o"]), ("q", "big energy south", "l", "Train S(3)", ["o"])], "country_norm string, name_norm string, section string, unit_name string, owners array<string>")
    assert [tuple(r) for r in reconcile.match_designators(report, units).collect()] == [("q", "big energy s(2)", "l", "big energy south", "Train S(2)")]


def test_fuzzy_pass_reads_aliases_families_and_designators(spark):
    report = side(spark, [("a", "old beta harbour", "l", 2.0, []), ("c", "tianjin (sinoco)", "l", 1.0, ["sinoco"]), ("q", "big energy s(2)", "l", 3.0, []), ("d", "gama", "l", 1.0, []), ("e", "north bay", "l", 1.0, ["o"]), ("f", "upper lake quay", "l", 1.0, []), ("g", "alone (owner)", "l", 1.0, [])])
    register = side(spark, [("a", "beta", "l", 2.0, []), ("c", "tianjin (pipeco)", "l", 1.0, []), ("c", "tianjin (sinoco) nangang (sinoco)", "l", 1.0, []), ("c", "tianjin nangang (sinoco)", "l", 1.0, []), ("c", "tianjin nangang (otherco)", "l", 1.0, []), ("q", "big energy south", "l", 9.0, []), ("q", "big energy s(2) old", "l", 9.0, []), ("d", "xgamagori", "l", 1.0, []), ("e", "north port", "l", 1.0, ["o"]), ("f", "x", "l", 1.0, []), ("g", "other place", "l", 1.0, ["owner"])])
    register = register.withColumn("unit_names", reconcile.F.when(reconcile.F.col("name_norm") == "big energy south", reconcile.F.array(reconcile.F.lit("Train S(2)"))).otherwise(reconcile.F.array().cast("array<string>")))
    alias = spark.createDataFrame([("a", "old beta", "l", "beta"), ("f", "lake upper", "l", "x")], "country_norm string, alias_norm string, section string, register_name string")
    out = {r.name_norm: (r.how, r.register_name) for r in reconcile.reconcile(report, register, alias).collect() if r.how != "register_only"}
    assert out["old beta harbour"] == ("fuzzy", "beta") and out["upper lake quay"] == ("fuzzy", "x")
    assert out["big energy s(2)"] == ("designator", "big energy south")
    assert out["gama"] == ("fuzzy", "xgamagori") and out["north bay"] == ("fuzzy", "north port") and out["alone (owner)"] == ("report_only", None)
    family = side(spark, [("c", "tianjin (pipeco)", "l", 1.0, []), ("c", "tianjin (sinoco)", "l", 1.0, [])])
    one = side(spark, [("c", "tianjin", "l", 1.0, ["sinoco"])])
    assert [tuple(r) for r in reconcile.reconcile(one, family, alias).filter("how = 'fuzzy'").collect()] == [("c", "tianjin", "l", "tianjin (sinoco)", "fuzzy")]


def test_vessels(spark):
    units = spark.createDataFrame([("1", "Star"), ("2", "Moon Light"), ("3", "Sun"), ("4", ""), ("5", "Nova")], "unit_id string, vessel_name string")
    other = spark.createDataFrame([(1, "STAR"), (2, "Moon"), (3, "Sunrise"), (4, "Sunset"), (5, "star")], "row int, vessel_name string")
    out = {r.unit_id: (r.other_name, r.how) for r in indexes.match_vessels(units, other).collect()}
    assert out == {"1": ("star", "exact"), "2": ("Moon", "contained"), "3": (None, "ambiguous"), "4": (None, "unnamed"), "5": (None, "missing")}


def test_walk_takes_the_first_parent_and_stops_at_leaves():
    graph = traversal.Graph(keys={"a": "id", "b": "id", "c": None, "d": "id", "look": "id"}, links=(traversal.ForeignKey("b", "a_id", "a", "id"), traversal.ForeignKey("c", "a_id", "a", "id"), traversal.ForeignKey("d", "c_id", "c", "id"), traversal.ForeignKey("c", "b_id", "b", "id"), traversal.ForeignKey("look", "a_id", "a", "id"), traversal.ForeignKey("d", "b_x", "b", "x")), reference=frozenset({"look"}))
    assert [(s.table, s.depth, s.column) for s in graph.walk("a")] == [("a", 0, None), ("b", 1, "a_id"), ("c", 1, "a_id")]
    with pytest.raises(ValueError):
        graph.walk("c")
    with pytest.raises(ValueError):
        traversal.read_only(" DELETE FROM a")
    assert traversal.read_only("(SELECT 1)") and traversal.file_name("a b/c") == "a_b_c"


def test_flat_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text('﻿Id,Name ,Odd\n1,"a, ""b""",z\n2,,y\n3\n', encoding="utf-8")
    df = flat.read_flat(spark, str(tmp_path / "x.csv"), {"id": "Id", "name": "Name", "gone": "Gone"})
    assert sorted(map(tuple, df.collect())) == [("1", 'a, "b"', None), ("2", None, None)]
    head = flat.match_header(["﻿Id", "Name ", "Odd"], {"id": "Id", "name": "Name", "gone": "Gone"})
    assert head.missing == ["gone"] and head.unknown == ["Odd"]
    assert flat.read_json_list(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "l.json").write_text('[{"a": 1}, {"a": 2}]')
    assert flat.read_json_list(spark, str(tmp_path / "l.json"), "a int").count() == 2
    (tmp_path / "p.txt").write_text("TABLE one\fother\fTABLE two")
    assert flat.read_page_texts(spark, str(tmp_path / "p.txt"), "TABLE").count() == 2
    said = flat.write_package({"one": df, "two": df.drop("gone")}, str(tmp_path / "out"), ("id",))
    assert said == [("one", 2, ""), ("two", 1, "")]
    flat.write_flat(df, str(tmp_path / "flat"), ["id"])
    assert spark.read.csv(str(tmp_path / "flat"), header=True).count() == 2


def test_levels_and_lists(spark):
    plants = spark.createDataFrame([(1, True, 10), (2, False, 20)], "plant int, own boolean, unit int")
    owners = spark.createDataFrame([(1, 20, "p"), (None, 20, "u"), (None, 10, "v")], "plant int, unit int, name string")
    out = {(r.plant, r.name) for r in relational.by_level(plants, owners, "own", "plant", "unit").collect()}
    assert out == {(1, "p"), (2, "u")}
    lists = relational.grouped_lists(spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k int, o int, v string"), "k", ["o"], ["v"], "rows").first()
    assert [r.v for r in lists.rows] == ["a", "b"]


def test_latest_status_as_a_stream(spark, tmp_path):
    kinds = "unit_id int, ts timestamp, status string, substatus string"
    rows = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01 00:00:00', 'proposed', ''), (1, timestamp'2024-01-02 00:00:00', 'operating', 'actual'), (1, timestamp'2024-01-03 00:00:00', 'retired', 'planned') AS t(unit_id, ts, status, substatus)")
    rows.write.json(str(tmp_path / "in"))
    stream = latest.latest(spark.readStream.schema(kinds).json(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("latest_status_test").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.unit_id, r.status) for r in spark.table("latest_status_test").collect()] == [(1, "operating")]


def test_subnames_merge_only_when_the_sum_fits_better(spark):
    kinds = "country_norm string, name_norm string, section string, capacity double, n_units int"
    report = spark.createDataFrame([("o", "oman lng", "l", 7.8, 1), ("o", "qalhat", "l", 3.7, 1), ("x", "north", "l", 5.0, 1), ("x", "south", "l", 5.0, 1)], kinds)
    register = spark.createDataFrame([("o", "oman qalhat", "l", 11.4, 3), ("x", "north south", "l", 5.0, 2)], kinds)
    alias = spark.createDataFrame([], "country_norm string, alias_norm string, section string")
    plain = report.withColumn("name_norm", reconcile.F.regexp_replace("name_norm", " lng", ""))
    out = sorted((r.name_norm, r.register_name, r.survivor) for r in reconcile.merge_subnames(plain, register, alias).collect())
    assert out == [("oman", "oman qalhat", "oman"), ("qalhat", "oman qalhat", "oman")]


def test_units_align_once_and_whole_rows_do_not(spark):
    rows = spark.createDataFrame([("m", 1, "Arzew GL1Z", 8.0), ("m", 2, "Arzew GL1Z", 8.0), ("m", 3, "Arzew GL2Z", 8.4), ("p", 1, "Portovaya T1", 1.5)], "match string, row int, site string, capacity double")
    units = spark.createDataFrame([("m", 1, "GL1Z", 8.0, 17.0), ("m", 2, "GL2Z", 8.4, 17.0), ("p", 1, "T1", 0.75, 1.5)], "match string, row int, unit_name string, capacity double, total double")
    assert sorted(map(tuple, reconcile.align_units(rows, units).collect())) == [("m", 1, "GL1Z"), ("m", 3, "GL2Z")]


def test_prose_turns_rows_off(spark):
    rows = spark.createDataFrame([(1, "indonesia", "Bontang Train F", 2.9, True), (2, "indonesia", "Bontang Train F", 2.9, True), (3, "indonesia", "Bontang Train E", 2.9, True)], "row int, country_norm string, site string, capacity double, operating boolean")
    fixes = spark.createDataFrame([(1, "indonesia", "Train F", 2.9)], "id int, country_norm string, site string, capacity double")
    assert [(r.row, r.operating) for r in reconcile.correct_by_prose(rows, fixes).orderBy("row").collect()] == [(1, False), (2, True), (3, True)]


def test_vessels_meet_by_their_rarest_word_and_once_each(spark):
    from gaugeworks.operators import vessels

    rows = [("x", "port", "regas", i, f"Alpha Ship{i % 2}") for i in range(400)] + [("x", "bay", "regas", 900, ""), ("x", "bay", "regas", 901, None)]
    register = [("x", f"terminal {i:03d}", "regas", f"Alpha Ship{i % 2}, Alpha Other{i}") for i in range(300)] + [("y", "a", "regas", "Alpha Ship0")]
    shape = "country_norm string, name_norm string, section string"
    own, at = spark.createDataFrame(rows, f"{shape}, row int, vessel_name string"), spark.createDataFrame(register, f"{shape}, vessel_name string")
    out = {r["row"]: (r["name_norm"], r["register_name"]) for r in vessels.route(own, at).collect()}
    assert len(out) == 402 and out[900] == out[901] == ("bay", None)
    assert out[0] == ("port ## terminal 000", "terminal 000") and out[399] == ("port ## terminal 001", "terminal 001")


def test_prose_finds_rows_by_words_and_capacity(spark):
    from gaugeworks.operators import reconcile

    rows = [(1, "x", "north bay", 1.0), (2, "x", "north bay", 1.0), (3, "x", "south bay", 2.04), (4, "x", "east", None), (5, "y", "north bay", 1.0), (6, "x", "west", 7.0), (7, None, "north bay", 1.0)]
    own = spark.createDataFrame([(*r, True) for r in rows], "row int, country_norm string, site string, capacity double, operating boolean")
    asked = [(1, "x", "bay north", 1.04), (2, "x", "bay", 2.0), (3, "x", "east", None), (4, "x", "east", 1.0), (5, "y", "bay quay", None), (6, "x", "", 7.04), (7, "x", "north", 1.06), (8, None, "bay", 1.0), (9, "x", None, float("nan"))]
    told = spark.createDataFrame(asked, "id int, country_norm string, site string, capacity double")
    out = {r["row"]: r["operating"] for r in reconcile.correct_by_prose(own, told).collect()}
    assert out == {1: False, 2: True, 3: False, 4: False, 5: True, 6: False, 7: True}
    crowd = spark.range(600).selectExpr("CAST(id AS INT) AS row", "'x' AS country_norm", "concat('bay w', id) AS site", "id * 1.0D AS capacity", "true AS operating")
    many = spark.range(600).selectExpr("CAST(id AS INT) AS id", "'x' AS country_norm", "concat('bay w', id) AS site", "id * 1.0D AS capacity")
    out = reconcile.correct_by_prose(crowd, many)
    assert out.filter("operating").isEmpty()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 0.05" in plan and all("word" in line for line in plan.splitlines() if "Join Inner" in line and "<= 0.05" in line)


def _joined_rows(spark, df) -> int:
    """The most rows that a join of df gives as it runs."""
    df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    number = store.executionsList().last().executionId()
    values, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
    found = [0]
    for node in (nodes.apply(i) for i in range(nodes.size()) if "Join" in nodes.apply(i).name()):
        for metric in (node.metrics().apply(j) for j in range(node.metrics().size())):
            if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                found.append(int(values.apply(metric.accumulatorId()).replace(",", "")))
    return max(found)


def test_parts_of_names_that_share_a_common_word_make_no_crowd(spark):
    n, kinds = 300, "country_norm string, name_norm string, section string, capacity double"
    report = spark.createDataFrame([("a", f"free{i} south", "l", 1.0) for i in range(n)] + [("a", f"part{i} south", "l", float(i)) for i in (1, 2)] + [("a", "grand south", "l", 4.0), ("a", "grand", "l", 2.0)], kinds)
    register = spark.createDataFrame([("a", f"held{i} south", "l", 1.0, 2) for i in range(n)] + [("a", "grand south quay", "l", 6.0, 2)], kinds + ", n_units long")
    alias = spark.createDataFrame([], "country_norm string, alias_norm string, section string, register_name string")
    out = reconcile.merge_subnames(report, register, alias)
    assert _joined_rows(spark, out) <= 4 * n  # by the common word alone they would be n * n
    assert sorted((r.name_norm, r.register_name, r.survivor) for r in out.collect()) == [("grand", "grand south quay", "grand south"), ("grand south", "grand south quay", "grand south")]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_take_units_in_turn_without_a_group_in_python(spark, seed):
    pick = random.Random(seed)
    pairs = [(f"m{m}", r, u, f"n{pick.randrange(4)}") for m in range(40) for r in range(5) for u in pick.sample(range(9), pick.randrange(4))]
    want = []
    for m in sorted({p[0] for p in pairs}):
        used = set()
        for r in range(5):
            left = [p for p in sorted(p for p in pairs if p[:2] == (m, r)) if p[3] not in used]
            if left:
                used.add(left[0][3])
                want.append((m, r, left[0][3]))
    out = relational.taken_once(spark.createDataFrame(pairs, "match string, row long, unit_row long, unit_name string"))
    assert sorted(tuple(x) for x in out.collect()) == want
    rows = spark.createDataFrame([], "match string, row long, site string, trains string, capacity double")
    units = spark.createDataFrame([], "match string, row long, unit_name string, status string, capacity double, total double")
    assert "Pandas" not in reconcile.align_units(rows, units)._jdf.queryExecution().executedPlan().toString()


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    def files() -> int:
        return sum(name.startswith("shuffle_") for _, _, names in os.walk(spark.conf.get("spark.local.dir")) for name in names)

    before = files()
    out = flat.checkpointed(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    assert out.count() == 7 and files() <= before
    assert spark.conf.get(flat.SHORT_LIVED) == "false"
