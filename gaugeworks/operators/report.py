"""Tables out of the layout text of an annual report: pages to lines, lines to rows, rows to countries.

Pages come as (report, page, text), or (page, text) of one report. Lines are exploded with their number, columns
come from the header's words, and every line is classified by expressions. Only the walk that spends a country's
published total on its rows, line by line, is a function of one page. What goes across pages is done for each
report on its own, by windows over rows that are dealt once a step and hold no more than place, country and capacity.

Null texts have no lines. A page without header gives no rows. Totals stand on lines of their own, beside a piece of
a name, or in the first cell of a data row; a label may be set on several lines (`bands`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..sources.flat import checkpointed

WIDE = 10_000
TOLERANCE = 1.02
#: Words in a closing bracket that tell a status, and marks of a facility that belong to the name.
NONOP_HINTS = {
    "mothballed": ["mothball", "mothballed", "mothballing"],
    "idled": ["halted", "idle", "idled", "idling", "paused", "shut", "shutdown", "stop", "stopped", "suspended"],
    "retired": ["closed", "decommissioned", "retired"],
    "cancelled": ["canceled", "cancelled"],
    "shelved": ["shelved"],
}
FACILITY_MARKS = ("FLNG", "FSRU", "FSU", "FRU", "FPSO")
#: What a page's foot says, somewhere in its line.
_FOOTER = r"(?i)\bannual\s+report\s+\d{4}\s+edition\b"
_NUMBER, _SUBTOTAL, _REGION = r"^-?\d+(?:\.\d+)?$", r"^([\d,.]+)\s*MTPA\s*$", r"^\s*[A-Z][A-Z\s&-]+:\s*[\d,.]+\s*MTPA"


@dataclass(frozen=True)
class Layout:
    """Header words in order; which column is the name and which the capacity."""

    words: tuple[str, ...]
    name: str
    capacity: str


#: What tells a page.
KEY = ["report", "page"]


def lines_of(pages: DataFrame) -> DataFrame:
    """(report, page, n, line); a table without report is one report."""
    report = F.col("report") if "report" in pages.columns else F.lit("")
    return pages.select(report.alias("report"), "page", F.posexplode(F.split("text", r"\r?\n")).alias("n", "line"))


def _starts(line: Column, layout: Layout) -> Column:
    """Where each header word begins in a line that holds all of them in order and begins with the first; else null."""
    at: list[Column] = []
    for word in layout.words:
        after = (at[-1] + len(layout.words[len(at) - 1])) if at else F.lit(1)
        found = F.call_function("locate", F.lit(word), line, after)
        at.append(F.when(found > 0, found) if not at else F.when(at[-1].isNotNull() & (found > 0), found))
    return F.when(F.ltrim(line).startswith(layout.words[0]) & at[-1].isNotNull(), F.array(*at))


def header(lines: DataFrame, layout: Layout) -> DataFrame:
    """(page, header_n, starts): the first line that begins with the first word and holds all words in order; starts: where each begins."""
    own = lines.withColumn("starts", _starts(F.col("line"), layout)).filter("starts IS NOT NULL")
    return own.groupBy(*KEY).agg(F.min_by(F.struct(F.col("n").alias("header_n"), "starts"), "n").alias("h")).select(*KEY, "h.header_n", "h.starts")


def headed(pages: DataFrame, layout: Layout) -> DataFrame:
    """(report, page, n, line, starts): the lines below each page's header, which is looked for before the page is cut into rows."""
    report = F.col("report") if "report" in pages.columns else F.lit("")
    whole = pages.select(report.alias("report"), "page", F.split("text", r"\r?\n").alias("all"))
    tried = F.transform("all", lambda x, i: F.struct(i.alias("header_n"), _starts(x, layout).alias("starts")))
    found = whole.withColumn("h", F.get(F.filter(tried, lambda x: x.starts.isNotNull()), F.lit(0))).filter("h IS NOT NULL")
    return found.select(*KEY, "h", F.posexplode("all").alias("n", "line")).filter("n > h.header_n").select(*KEY, "n", "line", "h.starts")


def cells(lines: DataFrame, heads: DataFrame, layout: Layout) -> DataFrame:
    """Lines below the header with a map of column -> trimmed text."""
    return cut(lines.join(heads, KEY).filter("n > header_n"), layout)


def cut(lines: DataFrame, layout: Layout) -> DataFrame:
    """Lines with starts, cut into a map of column -> trimmed text."""
    text = lambda i: F.trim(F.substring(F.col("line"), F.col("starts")[i] if i else F.lit(1), (F.col("starts")[i + 1] - (F.col("starts")[i] if i else F.lit(1))) if i + 1 < len(layout.words) else F.lit(WIDE)))
    entries = [x for i, w in enumerate(layout.words) for x in (F.lit(w), text(i))]
    return lines.select(*KEY, "n", "line", F.create_map(*entries).alias("cell"))


def classified(lines: DataFrame, layout: Layout) -> DataFrame:
    """Adds kind: data, label, subtotal, region, footer, blank or text; subtotal: the figure of a total, on its own line or in a data row's first cell."""
    first, rest = F.col("cell")[layout.words[0]], F.array_join(F.map_values(F.map_filter("cell", lambda k, v: k != layout.words[0])), "")
    capacity = F.col("cell")[layout.capacity]
    figure = F.regexp_replace(F.regexp_extract(first, _SUBTOTAL, 1), ",", "").try_cast("double")
    kind = (
        F.when(F.trim("line") == "", "blank")
        .when(F.col("line").rlike(_FOOTER), "footer")
        .when(F.col("line").rlike(_REGION), "region")
        .when(F.split(capacity, r"\s+")[0].rlike(_NUMBER), "data")
        .when(first.rlike(_SUBTOTAL) & (capacity == ""), "subtotal")
        .when((first != "") & (rest == "") & ~first.rlike(_NUMBER) & ~first.contains(":"), "label")
        .otherwise("text")
    )
    return lines.withColumn("kind", kind).withColumns({"label": F.when(F.col("kind") == "label", first), "subtotal": F.when(F.col("kind").isin("subtotal", "data"), figure)})


def bands(lines: DataFrame, reach: int = 3) -> DataFrame:
    """(report, page, n, label): labels, those on several lines put together at the first.

    Label lines with no data line between them are one stretch (they have equally many data lines before them), and
    a stretch is cut anew where a line is more than `reach` below the first of its label. A slash at a line's end
    stays one, other ends are joined by a blank.
    """
    page = Window.partitionBy(*KEY).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    told = lines.withColumn("above", F.count(F.when(F.col("kind") == "data", 1)).over(page)).filter("kind = 'label'")
    stretch = told.groupBy(*KEY, "above").agg(F.sort_array(F.collect_list(F.struct("n", F.trim("label").alias("label")))).alias("own"))

    def add(done: Column, line: Column) -> Column:
        last = F.element_at(done, -1)
        near = (F.size(done) > 0) & (line.n - F.try_element_at(done, F.lit(-1)).n <= reach)
        glue = F.when(F.rtrim(last.label).endswith("/"), "/").otherwise(" ")
        both = F.struct(last.n.alias("n"), F.concat(F.rtrim(F.regexp_replace(last.label, "[/-]+$", "")), glue, line.label).alias("label"))
        return F.when(near, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(F.concat(done, F.array(line)))

    kind = stretch.schema["own"].dataType.simpleString()
    return stretch.select(*KEY, F.inline(F.aggregate("own", F.array().cast(kind), add)))


def owned(lines: DataFrame, layout: Layout) -> DataFrame:
    """Adds row_n: the data line that a line of text belongs to, the nearest; of two as near the upper one, unless the line begins a name."""
    page = Window.partitionBy(*KEY)
    data = F.when(F.col("kind") == "data", F.col("n"))
    # both run from an end of the page: a frame that reaches to the end is summed anew for every line
    seen = lambda order: F.last(data, ignorenulls=True).over(page.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    above, below = F.col("__above"), F.col("__below")
    name = F.col("cell")[layout.name]
    opened = F.length(F.regexp_replace(name, r"[^(]", "")) - F.length(F.regexp_replace(name, r"[^)]", ""))
    continues = (opened < 0) | F.lower(name).isin("expansion", "extension") | name.rlike(r"(?i)\(\s*(?:FSRU|FLNG|FSU|FRU)\s*\)")
    begins = name.rlike(r"^\p{Lu}") & (F.col("cell")[layout.capacity] == "") & ~continues
    nearer = F.when(below.isNull() | (F.col("n") - above < below - F.col("n")), above).when(above.isNull() | (F.col("n") - above > below - F.col("n")), below).otherwise(F.when(begins, below).otherwise(above))
    # a total may stand beside a piece of a row's name
    own = F.col("kind").isin("data", "text") | ((F.col("kind") == "subtotal") & (name != ""))
    beside = lines.filter("kind <> 'blank'").withColumn("__below", seen(F.desc("n"))).withColumn("__above", seen(F.asc("n")))
    return beside.withColumn("row_n", F.when(own, nearer)).drop("__above", "__below")


def rows(lines: DataFrame, layout: Layout) -> DataFrame:
    """(report, page, n, country_cell, site, name_parts, capacity, cells): the lines of a row merged column by column, repeats in a row once.

    country_cell is the first piece in the first column that is no total, number or region.
    """
    parts = lines.filter("row_n IS NOT NULL").select(*KEY, F.col("row_n").alias("n0"), F.struct("n", F.transform(F.array(*map(F.lit, layout.words)), lambda w: F.col("cell")[w]).alias("v")).alias("part"))
    whole = parts.groupBy(*KEY, "n0").agg(F.sort_array(F.collect_list("part")).alias("own"))
    column = lambda i: F.filter(F.transform("own", lambda x: x.v[i]), lambda x: x != "")
    fresh = lambda p: F.filter(p, lambda x, i: (i == 0) | (x != F.get(p, i - 1)))
    several = whole.select(*KEY, "n0", *[column(i).alias(f"__{i}") for i in range(len(layout.words))])
    entries = F.array(*[F.struct(F.lit(w).alias("col"), fresh(F.col(f"__{i}")).alias("p")) for i, w in enumerate(layout.words)])
    merged = several.select(*KEY, "n0", F.map_from_entries(F.filter(entries, lambda x: F.size(x.p) > 0)).alias("pieces"))
    none = F.array().cast("array<string>")
    pieces = lambda k: F.coalesce(F.try_element_at("pieces", F.lit(k)), none)
    text = lambda k: F.array_join(pieces(k), " ")
    country = F.filter(pieces(layout.words[0]), lambda x: ~x.rlike(_SUBTOTAL) & ~x.rlike(_NUMBER) & ~x.contains(":"))
    number = F.regexp_replace(F.split(text(layout.capacity), r"\s+")[0], ",", "").try_cast("double")
    cells_of = F.transform_values("pieces", lambda k, v: F.array_join(v, " "))
    return merged.select(*KEY, F.col("n0").alias("n"), F.coalesce(F.get(country, F.lit(0)), F.lit("")).alias("country_cell"), text(layout.name).alias("site"), pieces(layout.name).alias("name_parts"), number.alias("capacity"), cells_of.alias("cells"))


def walked(table: DataFrame, lines: DataFrame) -> DataFrame:
    """(report, page, n, country, total): each row's country, and with n = -1 the total that a page gives a country.

    A row's country is its own cell's, else the label's above, while its published total lasts; rows past it wait for the next label.
    """
    none = F.lit(None)
    labels = bands(lines).select(*KEY, "n", F.lit(0).alias("turn"), F.col("label").alias("text"), none.cast("double").alias("value"))
    totals = lines.filter("subtotal IS NOT NULL").select(*KEY, "n", F.lit(1).alias("turn"), none.cast("string").alias("text"), F.col("subtotal").alias("value"))
    own = table.select(*KEY, "n", F.lit(2).alias("turn"), F.col("country_cell").alias("text"), F.coalesce("capacity", F.lit(0.0)).alias("value"))
    events = labels.unionByName(totals).unionByName(own)

    def walk(page: tuple, lines: Iterator[tuple]) -> Iterator[tuple]:
        country, budget, spent, waiting, out, published = "", None, 0.0, [], {}, {}
        for _, _, n, turn, text, value in lines:
            if turn == 1:
                if country:
                    budget = published[country] = value
                continue
            if turn == 0 or text:
                out.update(dict.fromkeys(waiting, text))
                country, budget, spent, waiting = text, None, 0.0, []
            if turn == 2:
                if text:
                    spent = value
                    out[n] = country
                elif country and (budget is None or spent + value <= budget * TOLERANCE):
                    spent += value
                    out[n] = country
                else:
                    waiting.append(n)
        yield from ((*page, n, c, None) for n, c in out.items())
        yield from ((*page, -1, c, v) for c, v in published.items())

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages one after the other, each in the order of its lines, whatever batches cut them."""
        kinds: list[pa.DataType] = []

        def stream() -> Iterator[tuple]:
            for batch in batches:
                kinds[:] = batch.schema.types[:2]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        found = (row for page, lines in groupby(stream(), key=lambda e: e[:2]) for row in walk(page, lines))
        while some := list(islice(found, 10_000)):
            fields = zip([*KEY, "n", "country", "total"], [*kinds, pa.int32(), pa.string(), pa.float64()], zip(*some, strict=True), strict=True)
            yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for name, kind, values in fields})

    kinds = dict(table.dtypes)
    ordered = events.select(*KEY, "n", "turn", "text", "value").repartition(*KEY).sortWithinPartitions(*KEY, "n", "turn")
    return ordered.mapInArrow(walks, f"report {kinds['report']}, page {kinds['page']}, n int, country string, total double")


def with_countries(table: DataFrame, told: DataFrame) -> DataFrame:
    named = told.filter("n >= 0").select(*KEY, "n", "country")
    return table.join(named, [*KEY, "n"], "left").withColumn("country", F.coalesce("country", F.lit("")))


def assign_countries(table: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds country, by the walk over each page."""
    return with_countries(table, walked(table, lines))


def country_totals(table: DataFrame, lines: DataFrame) -> DataFrame:
    """(report, country, total): each published total with the country of the data row nearest to it."""
    marks = lines.filter("subtotal IS NOT NULL").select(*KEY, "n", F.lit(1).alias("turn"), F.lit(None).cast("string").alias("country"), "subtotal")
    both = marks.unionByName(table.filter("country <> ''").select(*KEY, "n", F.lit(0).alias("turn"), "country", F.lit(None).cast("double").alias("subtotal")))
    page, row = Window.partitionBy(*KEY), F.when(F.col("turn") == 0, F.struct("n", "country"))
    seen = lambda *order: F.last(row, ignorenulls=True).over(page.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    # a row on the total's own line is above it; of two as near the upper one counts
    beside = both.withColumn("below", seen(F.desc("n"), F.desc("turn"))).withColumn("above", seen("n", "turn")).filter("turn = 1")
    upper = F.col("below").isNull() | (F.col("n") - F.col("above.n") <= F.col("below.n") - F.col("n"))
    nearest = beside.withColumn("country", F.when(upper, F.col("above.country")).otherwise(F.col("below.country"))).filter("country IS NOT NULL")
    return nearest.groupBy("report", "country").agg(F.max_by("subtotal", F.struct("page", "n")).alias("total"))


def _shared(totals: DataFrame, part: tuple[str, ...]) -> list[str]:
    """The columns of a part that the totals are told apart by."""
    return [c for c in part if c in totals.columns]


def with_totals(table: DataFrame, totals: DataFrame, part: tuple[str, ...]) -> DataFrame:
    """Adds total, the published one of a row's country: a part's few totals meet its rows by the part alone, so that rows need not be dealt by country."""
    shared = _shared(totals, part)
    lists = totals.groupBy(*shared).agg(F.collect_list(F.struct("country", "total")).alias("__totals"))
    both = table.join(lists, shared, "left") if shared else table.crossJoin(F.broadcast(lists))
    own = F.get(F.filter("__totals", lambda x: x.country == F.col("country")), F.lit(0))
    return both.withColumn("total", own.total).drop("__totals")


#: Halves of country names that a report sets on two lines.
SPLIT_NAMES = [("south", "korea", "South Korea"), ("equatorial", "guinea", "Equatorial Guinea"), ("papua", "new guinea", "Papua New Guinea"), ("papua new", "guinea", "Papua New Guinea"), ("trinidad &", "tobago", "Trinidad and Tobago"), ("trinidad and", "tobago", "Trinidad and Tobago"), ("trinidad", "tobago", "Trinidad and Tobago"), ("mauritania", "senegal", "Mauritania")]


def _order(part: tuple[str, ...]) -> Window:
    return Window.partitionBy(*part).orderBy("page", "n")


def _run(part: tuple[str, ...]) -> Window:
    """All rows of a run, in order."""
    return Window.partitionBy(*part, "run").orderBy("page", "n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def country_runs(table: DataFrame, part: tuple[str, ...]) -> DataFrame:
    """table with run, the number of its run of equal countries inside a part, before and after, the countries beside the run, and alone, the run's own sum."""
    w, run = _order(part), _run(part)
    own = table.withColumns({"__last": F.lag("country").over(w), "__next": F.lead("country").over(w), "__i": F.row_number().over(w)})
    new = F.when(F.col("__last").eqNullSafe(F.col("country")) & (F.col("__i") > 1), 0).otherwise(1)
    numbered = own.withColumn("run", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.withColumns({"before": F.first("__last").over(run), "after": F.last("__next").over(run), "alone": F.sum("capacity").over(run)}).drop("__last", "__next", "__i")


def join_split_names(table: DataFrame, totals: DataFrame, part: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The table, written, and the totals with countries whose name stands on two lines, half by half, put together again."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "/+$", ""), r"\s+", " "))
    whole = F.create_map(*[F.lit(x) for a, b, full in SPLIT_NAMES for x in (f"{a}\n{b}", full)])
    led = country_runs(table, part).withColumns({"__own": plain("country"), "__next": plain("after"), "__last": plain("before")})
    pair = lambda one, two: F.try_element_at(whole, F.concat_ws("\n", F.coalesce(one, F.lit("")), F.coalesce(two, F.lit(""))))
    own = checkpointed(led.withColumn("__full", F.coalesce(pair(F.col("__own"), F.col("__next")), pair(F.col("__last"), F.col("__own")))).select(*table.columns, "__full"))
    by = [*_shared(totals, part), "country"]
    renamed = own.filter("__full IS NOT NULL").select(*by, "__full").distinct().groupBy(*by).agg(F.min("__full").alias("__full"))
    out = own.withColumn("country", F.coalesce("__full", "country")).select(*table.columns)
    again = totals.join(renamed, by, "left").withColumn("country", F.coalesce("__full", "country")).groupBy(*by).agg(F.max("total").alias("total"))
    return out, again


def reclaim(table: DataFrame, totals: DataFrame, part: tuple[str, ...], nearest: bool, low: float = 0.94, high: float = 1.02) -> DataFrame:
    """Rows above a run that lacks them for its country's published total, given back by the country before it.

    Only runs between two others, with a total that they don't reach. Rows are taken upwards from the run as long as they
    are the preceding run's: up to `high` of the total (page by page), or as many as come nearest to it. They change
    hands only if the run then lies within low and high of the total. All in windows over a part's rows.
    """
    col, all_of = F.col, Window.partitionBy(*part, "run")
    led = with_totals(country_runs(table, part), totals, part)
    lack = F.when(col("before").isNotNull() & col("after").isNotNull() & (col("alone") < col("total") * low), F.struct(col("country").alias("to"), col("alone").alias("own"), "total"))
    # what the run below lacks is told to all rows of a run
    told = led.withColumn("__below", F.lead(lack).over(_order(part))).withColumn("__lack", F.last("__below").over(_run(part)))
    up, own, total = all_of.orderBy(F.desc("page"), F.desc("n")), col("__lack.own"), col("__lack.total")
    reached = told.withColumns({"__sum": own + F.sum(F.coalesce("capacity", F.lit(0.0))).over(up.rowsBetween(Window.unboundedPreceding, 0)), "__m": F.row_number().over(up)})
    if nearest:
        fit = F.when(col("__lack").isNotNull(), F.struct(F.abs(col("__sum") - total).alias("d"), "__m", "__sum"))
        best = reached.withColumn("__b", F.min(fit).over(all_of))
        better = col("__b.d") < F.abs(own - total)
    else:
        # upwards until the total is nearly met, and never past it
        bad = F.when((col("__sum") - F.coalesce("capacity", F.lit(0.0)) >= total * low) | (col("__sum") > total * high), col("__m"))
        stop = reached.withColumn("__stop", F.min(bad).over(all_of))
        open_ = col("__lack").isNotNull() & (col("__stop").isNull() | (col("__m") < col("__stop")))
        best = stop.withColumn("__b", F.max(F.when(open_, F.struct("__m", "__sum"))).over(all_of))
        better = F.lit(True)
    moves = better & (col("__b.__sum") >= total * low) & (col("__b.__sum") <= total * high) & (col("__m") <= col("__b.__m"))
    return best.withColumn("country", F.when(moves, col("__lack.to")).otherwise(col("country"))).select(*table.columns)


def settled(table: DataFrame, totals: DataFrame, part: tuple[str, ...], most: int = 8) -> DataFrame:
    """Reclaiming, the nearest fit, until a round moves no row or `most` are done: a country that gives rows up may come to lack some itself.

    A part without a moved row is settled, and only the others go into the next round. Their rows are counted as a round is written.
    """
    done, columns = [], table.columns
    for _ in range(most):
        seen = Observation()
        again = reclaim(table.withColumn("was", F.col("country")), totals, part, nearest=True)
        moved = F.max(~F.col("country").eqNullSafe(F.col("was"))).over(Window.partitionBy(*part))
        round_ = checkpointed(again.withColumn("moved", moved).drop("was").observe(seen, F.count_if("moved").alias("rows")))
        done.append(round_.filter("NOT moved").select(*columns))
        table = round_.filter("moved").select(*columns)
        if not seen.get["rows"]:
            return reduce(DataFrame.unionByName, done)
    return reduce(DataFrame.unionByName, done, table)


def return_islands(table: DataFrame, totals: DataFrame, part: tuple[str, ...] = ("page",), low: float = 0.94, high: float = 1.02) -> DataFrame:
    """A run between two runs of one other country goes to that country, if its own country's total is met without it and passed with it."""
    led = with_totals(country_runs(table, part), totals, part)
    judged = led.withColumn("all", F.sum("capacity").over(Window.partitionBy(*part, "country").orderBy("page", "n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    move = (F.col("before") == F.col("after")) & (F.col("before") != "") & (F.col("all") - F.col("alone") >= F.col("total") * low) & (F.col("all") > F.col("total") * high)
    return judged.withColumn("country", F.when(move, F.col("before")).otherwise(F.col("country"))).select(*table.columns)


def override_sites(table: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The country of the first rule whose words are in the site's name."""
    told = F.coalesce(*[F.when(F.lower("site").contains(words), F.lit(country)) for words, country in rules], F.col("country"))
    return table.withColumn("country", told)


def site_parts(project: Column) -> Column:
    """struct<site, trains, hint>: 'Yamal LNG T2' as ('Yamal LNG', 'T2', ''), 'X T1 (Mothballed)' with its hint; facility marks stay in the name."""
    own = F.trim(project)
    bracket = F.regexp_extract(own, r"\(([A-Za-z]{1,20})\)\s*$", 1)
    hint = F.when((bracket != "") & ~F.upper(bracket).isin(*FACILITY_MARKS), bracket).otherwise("")
    bare = F.when(hint != "", F.rtrim(F.regexp_replace(own, r"\([A-Za-z]{1,20}\)\s*$", ""))).otherwise(own)
    trains = F.regexp_extract(bare, r"\s+(T\d+(?:\s*[-–&,]\s*T?\d+)*)\s*$", 1)
    site = F.when(trains != "", F.rtrim(F.regexp_replace(bare, r"\s+T\d+(?:\s*[-–&,]\s*T?\d+)*\s*$", ""))).otherwise(bare)
    return F.struct(site.alias("site"), trains.alias("trains"), hint.alias("hint"))


def hinted_status(hint: Column) -> Column:
    table = F.create_map(*[F.lit(x) for status, words in NONOP_HINTS.items() for word in words for x in (word, status)])
    return F.coalesce(F.try_element_at(table, F.regexp_replace(F.lower(hint), "[^a-z]", "")), F.lit(""))


def terminal_parts(pieces: Column, concept: Column) -> Column:
    """struct<site, vessel, type, status> of the pieces of a terminal's name: pieces with a facility mark name its vessel.

    Where every piece has a mark, the first is the site and the last its vessel; one marked piece alone is both.
    """
    mark = r"(?i)\(\s*(?:FSRU|FLNG|FSU|FRU)\s*\)"
    bare = lambda x: F.trim(F.regexp_replace(x, r"\s*" + mark + r"\s*", " "))
    marked, plain = F.filter(pieces, lambda x: x.rlike(mark)), F.filter(pieces, lambda x: ~x.rlike(mark))
    n = F.size(marked)
    first = F.trim(F.regexp_replace(bare(F.get(marked, F.lit(0))), r"(?i)\s+(?:and|&)\s*$", ""))
    named = F.when(F.size(plain) > 0, F.array_join(plain, " ")).when(n >= 2, first).otherwise(F.array_join(pieces, " "))
    vessel = F.when(n > 0, bare(F.element_at(marked, -1))).otherwise("")
    bracket = F.regexp_extract(named, r"\(([A-Za-z]{1,20})\)\s*$", 1)
    status = hinted_status(bracket)
    site = F.when(status != "", F.rtrim(F.regexp_replace(named, r"\([A-Za-z]{1,20}\)\s*$", ""))).otherwise(named)
    kind = F.when(vessel != "", "FSRU").when(F.lower(concept).contains("offshore"), "offshore").when(F.lower(concept).contains("onshore"), "onshore").otherwise("")
    return F.struct(site.alias("site"), vessel.alias("vessel"), kind.alias("type"), status.alias("status"))


def table_rows(pages: DataFrame, layout: Layout, rules: list[tuple[str, str]] | None = None, rounds: int = 8) -> DataFrame:
    """The rows of all pages with their countries, settled within each report."""
    marked = checkpointed(classified(cut(headed(pages, layout), layout), layout).drop("line"))
    table = checkpointed(rows(owned(marked, layout), layout).filter("site <> ''"))
    told = checkpointed(walked(table, marked))
    placed = checkpointed(with_countries(table.select(*KEY, "n", "capacity"), told))
    totals = checkpointed(country_totals(placed, marked))
    published = told.filter("n < 0").select(*KEY, "country", "total")
    placed, totals = join_split_names(reclaim(placed, published, tuple(KEY), nearest=False), totals, ("report",))
    totals = checkpointed(totals)
    table = with_countries(table, return_islands(settled(placed, totals, ("report",), rounds), totals, ("report",)))
    return override_sites(table, rules) if rules else table


def extract(pages: DataFrame, layout: Layout, rules: list[tuple[str, str]] | None = None, rounds: int = 8) -> DataFrame:
    """(report, page, n, country, site, trains, status, capacity) of a plant table's pages."""
    table = table_rows(pages, layout, rules, rounds)
    part = site_parts(F.col("site"))
    return table.select(*KEY, "n", "country", part.site.alias("site"), part.trains.alias("trains"), F.when(hinted_status(part.hint) != "", hinted_status(part.hint)).otherwise("operating").alias("status"), "capacity")


def extract_terminals(pages: DataFrame, layout: Layout, concept: str, rules: list[tuple[str, str]] | None = None, rounds: int = 8) -> DataFrame:
    """(report, page, n, country, site, vessel, type, status, capacity) of a terminal table's pages; concept: the column that says onshore or offshore."""
    table = table_rows(pages, layout, rules, rounds)
    part = terminal_parts(F.col("name_parts"), F.coalesce(F.try_element_at("cells", F.lit(concept)), F.lit("")))
    return table.select(*KEY, "n", "country", part.site.alias("site"), part.vessel.alias("vessel"), part.type.alias("type"), F.when(part.status != "", part.status).otherwise("operating").alias("status"), "capacity")
