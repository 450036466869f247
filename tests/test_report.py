"""Report pages to rows: a page laid out by hand, with what such pages do to a reader."""

from __future__ import annotations

from gaugeworks.operators import report
from pyspark.sql import functions as F

LAYOUT = report.Layout(("Country", "Project", "(MTPA)", "Owner"), "Project", "(MTPA)")
PAGE = """Annual table of plants
Country      Project                  (MTPA)   Owner
ATLANTIC BASIN: 99 MTPA
USA          Alpha T1                 5.0      Shell
             Alpha T2 (Mothballed)    5.0      Shell
Brunei
7.2 MTPA
             Beta LNG T1-2            7.2      Total
             Gamma                    3.0      BP
Oman
             Delta (FLNG)             4.0      OQ
             first
"""


def test_page_to_rows(spark):
    out = report.extract(spark.createDataFrame([(1, PAGE), (2, "no table here")], "page int, text string"), LAYOUT, [("gamma", "Qatar")])
    got = [(r.country, r.site, r.trains, r.status, r.capacity) for r in out.orderBy("n").collect()]
    assert got == [("USA", "Alpha", "T1", "operating", 5.0), ("USA", "Alpha", "T2", "mothballed", 5.0), ("Brunei", "Beta LNG", "T1-2", "operating", 7.2), ("Qatar", "Gamma", "", "operating", 3.0), ("Oman", "Delta (FLNG) first", "", "operating", 4.0)]


def test_rows_past_the_total_wait_for_the_next_label(spark):
    lines = report.lines_of(spark.createDataFrame([(1, PAGE)], "page int, text string"))
    marked = report.classified(report.cells(lines, report.header(lines, LAYOUT), LAYOUT), LAYOUT)
    kinds = {r.n: r.kind for r in marked.collect()}
    assert [kinds[i] for i in range(2, 12)] == ["region", "data", "data", "label", "subtotal", "data", "data", "label", "data", "text"]
    table = report.assign_countries(report.rows(report.owned(marked, LAYOUT), LAYOUT), marked)
    assert {r.site: r.country for r in table.collect()}["Gamma"] == "Oman"
    assert [(r.country, r.total) for r in report.country_totals(table, marked).collect()] == [("Brunei", 7.2)]


def test_islands_go_back(spark):
    table = spark.createDataFrame([(1, 1, "J", 5.0), (1, 2, "I", 4.0), (1, 3, "J", 2.0), (1, 4, "I", 11.5)], "page int, n int, country string, capacity double")
    totals = spark.createDataFrame([("I", 11.5)], "country string, total double")
    assert [(r.n, r.country) for r in report.return_islands(table, totals).orderBy("n").collect()] == [(1, "J"), (2, "J"), (3, "J"), (4, "I")]
    kept = spark.createDataFrame([("I", 15.5)], "country string, total double")
    assert [r.country for r in report.return_islands(table, kept).orderBy("n").collect()] == ["J", "I", "J", "I"]


def test_site_parts(spark):
    names = ["Harbour Isle T4", "Stone Bay LNG T1-3", "Long Reach T2 (Closed)", "Moor Dua", "Tern (FLNG)", "Two Rivers T1 & T2"]
    got = [tuple(r.x) for r in spark.createDataFrame([(n,) for n in names], "a string").select(report.site_parts(F.col("a")).alias("x")).collect()]
    assert got == [("Harbour Isle", "T4", ""), ("Stone Bay LNG", "T1-3", ""), ("Long Reach", "T2", "Closed"), ("Moor Dua", "", ""), ("Tern (FLNG)", "", ""), ("Two Rivers", "T1 & T2", "")]


def test_terminal_parts(spark):
    rows = [(["Port A", "Big Ship (FSRU)"], "Offshore"), (["Port B (FSRU) and", "Small Ship (FSU)"], "x"), (["Port C (FSU)"], ""), (["Port", "D (Idle)"], "Onshore"), (["Port E (West)"], "OFFSHORE")]
    out = spark.createDataFrame(rows, "p array<string>, c string").select(report.terminal_parts(F.col("p"), F.col("c")).alias("x"))
    assert [tuple(r.x) for r in out.collect()] == [("Port A", "Big Ship", "FSRU", ""), ("Port B", "Small Ship", "FSRU", ""), ("Port C (FSU)", "Port C", "FSRU", ""), ("Port D", "", "onshore", "idled"), ("Port E (West)", "", "offshore", "")]


def _marked(spark, text):
    lines = report.lines_of(spark.createDataFrame([(1, text)], "page int, text string"))
    return report.classified(report.cells(lines, report.header(lines, LAYOUT), LAYOUT), LAYOUT)


HEAD = "Country      Project                  (MTPA)   Owner\n"


def test_totals_on_data_rows_and_wrapped_labels(spark):
    text = HEAD + "Oman\n             Alpha                    5.0      A\n12.0 MTPA    Beta                     7.0      A\nMauritania/\nSenegal\n             Gamma                    2.0      B\n3.0 MTPA     north\n             Delta                    1.0      B\n54 - Some Gas Group Annual Report 2026 Edition\n"
    out = report.extract(spark.createDataFrame([(1, text)], "page int, text string"), LAYOUT).orderBy("n").collect()
    assert [(r.country, r.site) for r in out] == [("Oman", "Alpha"), ("Oman", "Beta"), ("Mauritania/Senegal", "Gamma north"), ("Mauritania/Senegal", "Delta")]
    marked = _marked(spark, text)
    assert sorted(r.subtotal for r in marked.filter("subtotal IS NOT NULL").collect()) == [3.0, 12.0]
    assert [r.kind for r in marked.orderBy("n").collect()][-2:] == ["footer", "blank"]


def test_bands_against_the_rule_line_by_line(spark):
    import random

    pick = random.Random(12)
    for _ in range(6):
        lines, want = [], []
        for n in range(40):
            kind = pick.choice(["label", "label", "data", "blank"])
            word = f"L{n}" + pick.choice(["", "/", "-", " /"])
            lines.append({"label": word, "data": "             P                        1.0      A", "blank": ""}[kind])
            if kind == "data":
                open_at = None
            elif kind == "label":
                if want and open_at is not None and n - open_at <= 3:
                    last = want[-1][1]
                    want[-1] = (want[-1][0], last.rstrip("/-").rstrip() + ("/" if last.endswith("/") else " ") + word)
                else:
                    open_at = n
                    want.append((n, word))
            if kind == "data" or not want:
                open_at = None
        got = sorted((r.n - 1, r.label) for r in report.bands(_marked(spark, HEAD + "\n".join(lines))).collect())
        assert got == want


def test_a_chain_needs_five_rounds_and_reports_do_not_mix(spark):
    names = ["A"] * 3 + [c for c in ("C1", "C2", "C3", "C4") for _ in range(2)] + ["C5", "Z"]
    rows = [(r, 1 + i // 4, i, c, 5.0) for r in ("x", "y") for i, c in enumerate(names)]
    table = spark.createDataFrame(rows, "report string, page int, n int, country string, capacity double")
    totals = spark.createDataFrame([("x", f"C{i}", 10.0) for i in range(1, 6)], "report string, country string, total double")
    want = ["A"] * 2 + [c for c in ("C1", "C2", "C3", "C4", "C5") for _ in range(2)] + ["Z"]
    for most in (4, 8):
        out = report.settled(table, totals, ("report",), most).orderBy("report", "n").collect()
        assert ([r.country for r in out if r.report == "x"] == want) == (most == 8)
        assert [r.country for r in out if r.report == "y"] == names


def _table(spark, rows):
    return spark.createDataFrame([(1 + i // 6, i % 6, c, float(v), 1) for i, (c, v) in enumerate(rows)], "page int, n int, country string, capacity double, section int")


def _countries(df):
    return [r.country for r in df.orderBy("page", "n").collect()]


def _reclaimed(rows, totals, nearest):
    """The rule, row by row."""
    names, caps = [c for c, _ in rows], [v for _, v in rows]
    edges = [0] + [i for i in range(1, len(rows)) if names[i] != names[i - 1]] + [len(rows)]
    out = list(names)
    for a, b in zip(edges[1:-2], edges[2:-1]):
        total, own = totals.get(names[a]), sum(caps[a:b])
        if total is None or own >= 0.94 * total:
            continue
        first = a
        while first and names[first - 1] == names[a - 1]:
            first -= 1
        tries, reached = [], own
        for k in range(a - 1, first - 1, -1):
            if not nearest and (reached >= 0.94 * total or reached + caps[k] > 1.02 * total):
                break
            reached += caps[k]
            tries.append((abs(reached - total), a - k, reached))
        if not tries:
            continue
        d, m, end = min(tries) if nearest else tries[-1]
        if 0.94 * total <= end <= 1.02 * total and (not nearest or d < abs(own - total)):
            out[a - m : a] = [names[a]] * m
    return out


def test_reclaiming_against_the_rule_row_by_row(spark):
    import random

    pick = random.Random(6)
    for nearest in (False, True):
        rows = [(c, pick.choice([1, 2, 3])) for c in [pick.choice("ABCD") for _ in range(24)] for _ in range(pick.randint(1, 4))]
        totals = {c: pick.choice([4, 5, 7, 9]) for c in "ABC"}
        got = report.reclaim(_table(spark, rows), spark.createDataFrame([(c, float(v)) for c, v in totals.items()], "country string, total double"), ["section"], nearest)
        assert _countries(got) == _reclaimed(rows, totals, nearest)


def test_split_names_and_islands(spark):
    totals = spark.createDataFrame([("Korea", 9.0), ("A", 5.0), ("B", 4.0)], "country string, total double")
    table, again = report.join_split_names(_table(spark, [("A", 5), ("South ", 4), ("Korea", 5), ("B", 1)]), totals, ["section"])
    assert _countries(table) == ["A", "South Korea", "South Korea", "B"]
    assert {r.country: r.total for r in again.collect()} == {"South Korea": 9.0, "A": 5.0, "B": 4.0}
    back = report.return_islands(_table(spark, [("A", 3), ("B", 2), ("A", 2), ("C", 1), ("B", 4)]), totals, ["section"])
    assert _countries(back) == ["A", "A", "A", "C", "B"]


def test_status_words_and_footers(spark):
    words = {"(Shutdown)": "idled", "(closed)": "retired", "(suspended)": "idled", "(stop)": "idled", "(100)": "operating"}
    for word, status in words.items():
        part = report.site_parts(F.lit(f"Harbour T1 {word}"))
        assert (spark.range(1).select(report.hinted_status(part.hint).alias("s")).first().s or "operating") == status


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_rows_are_dealt_once_a_round(spark, capsys):
    table = spark.createDataFrame([("x", 1, 1, "A", 5.0)], "report string, page int, n int, country string, capacity double")
    totals = spark.createDataFrame([("x", "A", 5.0)], "report string, country string, total double")
    for nearest in (False, True):
        assert _plan(report.reclaim(table, totals, ("report",), nearest), capsys).count("Exchange hashpartitioning") <= 2
    assert _plan(report.return_islands(table, totals, ("report",)), capsys).count("Exchange hashpartitioning") <= 2


def test_nearest_lines_of_a_long_page_are_not_summed_anew(spark, capsys):
    assert "currentrow$(), unboundedfollowing$()" not in _plan(report.owned(_marked(spark, PAGE), LAYOUT), capsys)


def test_settled_reports_leave_the_rounds(spark, monkeypatch):
    names = ["A"] * 3 + [c for c in ("C1", "C2", "C3") for _ in range(2)] + ["C4", "Z"]
    rows = [(r, 1, i, c, 5.0) for r in ("x", "y", "z") for i, c in enumerate(names)]
    table = spark.createDataFrame(rows, "report string, page int, n int, country string, capacity double")
    totals = spark.createDataFrame([("x", f"C{i}", 10.0) for i in range(1, 5)] + [("z", "C4", 10.0)], "report string, country string, total double")
    seen, own = [], report.reclaim

    def watched(table, *more, **named):
        seen.append(sorted(r.report for r in table.select("report").distinct().collect()))
        return own(table, *more, **named)

    monkeypatch.setattr(report, "reclaim", watched)
    out = report.settled(table, totals, ("report",)).orderBy("report", "n").collect()
    assert seen == [["x", "y", "z"], ["x", "z"], ["x"], ["x"], ["x"]]
    assert [r.country for r in out if r.report == "x"] == ["A"] * 2 + [c for c in ("C1", "C2", "C3", "C4") for _ in range(2)] + ["Z"]
    assert [r.country for r in out if r.report == "y"] == names
    assert [r.country for r in out if r.report == "z"] == names[:-3] + ["C4", "C4", "Z"]


def test_pages_are_walked_whatever_batches_cut_them(spark):
    pages = spark.createDataFrame([(r, p, PAGE) for r in ("x", "y", None) for p in (1, 2)], "report string, page int, text string")
    lines = report.classified(report.cut(report.headed(pages, LAYOUT), LAYOUT), LAYOUT)
    table = report.rows(report.owned(lines, LAYOUT), LAYOUT)
    want = {(-1, "Brunei", 7.2), (3, "USA", None), (4, "USA", None), (7, "Brunei", None), (8, "Oman", None), (10, "Oman", None)}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in ("2", "3", size):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            got = sorted(report.walked(table, lines).collect(), key=str)
            assert {(r.report, r.page) for r in got} == {(r, p) for r in ("x", "y", None) for p in (1, 2)}
            for key in {(r.report, r.page) for r in got}:
                own = [(r.n, r.country, r.total) for r in got if (r.report, r.page) == key]
                assert set(own) == want and len(own) == 6
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_headers_found_in_pages_are_those_found_in_lines(spark):
    texts = [None, "", HEAD, PAGE, "Owner (MTPA) Project Country\nx", "a\r\n  " + HEAD + "Oman         P                        1.0      A\r\n" + HEAD + "\n\nQatar", "Country only\n" + PAGE + PAGE]
    pages = spark.createDataFrame([(1 + i // 3, i, t) for i, t in enumerate(texts)], "report int, page int, text string")
    lines = report.lines_of(pages)
    got, want = report.cut(report.headed(pages, LAYOUT), LAYOUT), report.cells(lines, report.header(lines, LAYOUT), LAYOUT)
    told = lambda df: sorted((r.report, r.page, r.n, r.line, sorted(r.cell.items())) for r in df.collect())
    assert told(got) == told(want) and len({r.page for r in got.collect()}) == 4


def test_totals_go_to_the_nearest_row(spark):
    import random

    pick = random.Random(3)
    rows, marks = [], []
    for page in range(12):
        for n in range(30):
            if pick.random() < 0.3:
                rows.append(("x", page, n, pick.choice(["A", "B", "C", ""])))
            if pick.random() < 0.2:
                marks.append(("x", page, n, float(pick.randint(1, 99))))
    want = {}
    for _, page, at, value in marks:
        near = min(((abs(n - at), n, c) for _, p, n, c in rows if p == page and c), default=None)
        if near:
            want[near[2]] = value
    got = report.country_totals(spark.createDataFrame(rows, "report string, page int, n int, country string"), spark.createDataFrame(marks, "report string, page int, n int, subtotal double"))
    assert {r.country: r.total for r in got.collect()} == want
