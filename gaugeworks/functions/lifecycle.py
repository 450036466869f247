"""Statuses over time: what is current, which years anchor a unit, what the rules forbid.

A timeline is an array of structs (order, status, substatus, year, month, refs array<bigint>), in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Which status may follow which, and which substatuses a status may have.
MOVES = {
    "proposed": "construction shelved cancelled",
    "construction": "operating shelved",
    "operating": "idled mothballed retired",
    "idled": "operating mothballed retired",
    "mothballed": "operating retired",
    "retired": "",
    "shelved": "cancelled construction operating",
    "cancelled": "proposed",
}
SUBSTATUSES = {"proposed": ["", "actual"], "construction": ["actual", "planned"], "operating": ["actual", "planned"], "idled": ["actual", "planned"], "mothballed": ["actual", "planned"], "retired": ["actual", "planned"], "shelved": ["confirmed", "inferred 2 y"], "cancelled": ["actual", "confirmed", "inferred 4 y"], "fid": ["actual", "planned"]}
ACTIVE = ("construction", "operating", "idled", "mothballed", "retired")
ENDED = ("retired", "stopped", "mothballed")


def _low(x: Column) -> Column:
    return F.lower(F.coalesce(x, F.lit("")))


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def _last(rows: Column) -> Column:
    return F.try_element_at(rows, F.lit(-1))


def _with(rows: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(rows, lambda r: test(r))


def current(timeline: Column) -> Column:
    """The entry that counts as current: the last neither planned nor a decision; else the last that is no decision; else the last."""
    rows = F.array_sort(timeline)
    real = _with(rows, lambda r: (_low(r.substatus) != "planned") & (_low(r.status) != "fid"))
    return F.coalesce(_last(real), _last(_with(rows, lambda r: _low(r.status) != "fid")), _last(rows))


def current_strict(timeline: Column) -> Column:
    """The status alone, lower-cased; '' if every entry is planned or a decision."""
    real = _with(F.array_sort(timeline), lambda r: (_low(r.substatus) != "planned") & (_low(r.status) != "fid"))
    return F.coalesce(_low(_last(real).status), F.lit(""))


def dormancy_kind(substatus: Column) -> Column:
    own = _low(substatus)
    return F.when(own.startswith("inferred"), "inferred").otherwise(own)


def anchors(timeline: Column) -> Column:
    """struct of the columns that a timeline gives: statuses, anchor years and months, and the reference ids behind them."""
    rows = F.array_sort(timeline)
    of = lambda *names: _with(rows, lambda r: _low(r.status).isin(*names))
    planned = lambda r: _low(r.substatus) == "planned"
    # a first entry without year gives way to the next one with a year, or to the last if none has one
    dated = lambda own: F.coalesce(F.try_element_at(_with(own, lambda r: _text(r.year) != ""), F.lit(1)), _last(own))
    proposed, construction = dated(of("proposed")), dated(of("construction"))
    operating, shelved, cancelled, ended, fid = of("operating"), of("shelved"), of("cancelled"), of(*ENDED), of("fid")
    starts, plans = _with(operating, lambda r: ~planned(r)), _with(operating, planned)
    stopped, stops = _last(_with(ended, lambda r: ~planned(r))), _last(_with(ended, planned))
    year = lambda r: _text(r.year)
    nth = lambda own, k: year(F.try_element_at(own, F.lit(k)))
    some = lambda x: F.when(x != "", x)
    dead, asleep = year(_last(cancelled)), year(_last(shelved))
    has_sub = lambda own: _with(own, lambda r: _low(r.substatus) != "")
    kind = F.coalesce(_last(has_sub(cancelled)), F.try_element_at(has_sub(shelved), F.lit(1)))
    now = current(timeline)
    none = F.array().cast("array<bigint>")
    refs = lambda r: F.coalesce(r.refs, none)
    return F.struct(
        _text(now.status).alias("status"),
        _text(now.substatus).alias("substatus"),
        refs(now).alias("status_refs"),
        year(proposed).alias("proposal_year"),
        _text(proposed.month).alias("proposal_month"),
        refs(proposed).alias("proposal_refs"),
        year(construction).alias("construction_year"),
        _text(construction.month).alias("construction_month"),
        refs(construction).alias("construction_refs"),
        nth(plans, 1).alias("original_planned_start"),
        year(_last(plans)).alias("latest_planned_start"),
        nth(starts, 1).alias("actual_start"),
        _text(F.try_element_at(starts, F.lit(1)).month).alias("actual_start_month"),
        nth(starts, 2).alias("actual_start_2"),
        nth(starts, 3).alias("actual_start_3"),
        F.flatten(F.transform(operating, refs)).alias("start_refs"),
        asleep.alias("shelved_year"),
        refs(_last(shelved)).alias("shelved_refs"),
        dead.alias("cancelled_year"),
        refs(_last(cancelled)).alias("cancelled_refs"),
        F.coalesce(some(dead), some(asleep), year(stopped)).alias("stop_year"),
        F.when(dead != "", refs(_last(cancelled))).when(asleep != "", refs(_last(shelved))).otherwise(refs(stopped)).alias("stop_refs"),
        year(stops).alias("planned_stop_year"),
        F.coalesce(dormancy_kind(kind.substatus), F.lit("")).alias("dormancy_kind"),
        F.when(F.size(fid) == 0, F.lit("")).when(planned(_last(fid)), "Pre-FID").otherwise("FID").alias("fid_status"),
        year(_last(fid)).alias("fid_year"),
        refs(_last(fid)).alias("fid_refs"),
    )


#: The anchor years that stand for a status, the first that is there.
ANCHOR_OF = {
    "proposed": ["proposal_year"],
    "construction": ["construction_year", "proposal_year"],
    "shelved": ["shelved_year"],
    "cancelled": ["cancelled_year", "shelved_year"],
    "idled": ["stop_year", "actual_start"],
    "mothballed": ["stop_year", "actual_start"],
    "retired": ["stop_year", "actual_start"],
}


def anchor_year(status: Column, years: dict[str, Column]) -> Column:
    """The year that stands for a status, as text; '' for other statuses and where no year is known."""
    some = lambda c: F.when(F.trim(c.cast("string")) != "", F.trim(c.cast("string")))
    per = [F.when(status == s, F.coalesce(*[some(years[y]) for y in names if y in years], F.lit(""))) for s, names in ANCHOR_OF.items()]
    return F.coalesce(*per, F.lit(""))


def move_reason(before: Column, after: Column) -> Column:
    """Why a status may or may not follow another."""
    known = F.create_map(*[x for k, v in MOVES.items() for x in (F.lit(k), F.lit(", ".join(v.split()) or "none"))])
    allowed = F.try_element_at(known, before)
    return F.when(before == after, "unchanged").when(allowed.isNull(), F.concat(F.lit("unknown status "), before)).when(legal_move(before, after), "legal").otherwise(F.concat(before, F.lit(" may lead to: "), allowed))


def legal_move(before: Column, after: Column) -> Column:
    """Whether a status may follow another; staying is legal, unknown statuses are not."""
    table = F.create_map(*[x for k, v in MOVES.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())).cast("array<string>"))])
    allowed = F.try_element_at(table, before)
    return (before == after) | F.coalesce(F.array_contains(allowed, after), F.lit(False))


def entry_warnings(status: Column, substatus: Column, year: Column, latest_active: Column | None = None) -> Column:
    """array<string>: what is wrong with a timeline entry. latest_active: year of the last active entry before it (null: no timeline is known)."""
    table = F.create_map(*[x for k, v in SUBSTATUSES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    allowed, own, y = F.try_element_at(table, _low(status)), _low(substatus), year.try_cast("int")
    inferred = own.isin("inferred 2 y", "inferred 4 y")
    checks = [
        F.when(allowed.isNotNull() & ~F.array_contains(allowed, own), "substatus_not_of_status"),
        F.when((_text(year) != "") & y.isNull(), "year_not_whole").when((y < 1960) | (y > 2100), "year_out_of_range"),
        F.when(inferred, "inferred_without_timeline") if latest_active is None else F.when(inferred & (y - latest_active < 2), "inferred_after_recent_activity"),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def anchor_warnings(years: dict[str, Column]) -> Column:
    """array<string>: pairs of anchor years in the wrong order. Keys: proposal, construction, actual_start, original_planned, latest_planned, shelved, cancelled, stop."""
    pairs = [("proposal", "construction"), ("construction", "actual_start"), ("proposal", "actual_start"), ("original_planned", "latest_planned"), ("actual_start", "stop"), ("shelved", "cancelled")]
    y = {k: v.try_cast("int") for k, v in years.items()}
    checks = [F.when(y[a] > y[b], f"{a}_after_{b}") for a, b in pairs if a in y and b in y]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def parse_date(text: Column) -> Column:
    """A date of 2024-05-01, 05/01/2024, 2024/05/01, 31/12/2024, 2024-05 or 2024; null else."""
    own = F.trim(text)
    forms = [(r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{4}-\d{1,2}$", "yyyy-M"), (r"^\d{4}$", "yyyy")]
    return F.coalesce(*[F.try_to_date(F.when(own.rlike(shape), own), form) for shape, form in forms])


def years_since(day: Column, today: Column) -> Column:
    return F.datediff(today, day) / 365.25


def stale_flags(status: Column, updated: Column, latest_planned: Column, today: Column) -> Column:
    """array<struct<flag, severity, years_stale, planned_year>> of a unit."""
    age = years_since(updated, today)
    planned = latest_planned.try_cast("int")
    none, flag = F.lit(None), lambda name, severity, years, start: F.struct(F.lit(name).alias("flag"), F.lit(severity).alias("severity"), years.cast("double").alias("years_stale"), start.cast("int").alias("planned_year"))
    old = F.bround(age, 1)
    rules = [
        F.when(status.isin("proposed", "construction", "idled", "mothballed") & (age >= 2.0), flag("inferred_shelved_candidate", "high", old, none)),
        F.when((status == "shelved") & (age >= 2.0), flag("inferred_cancelled_candidate", "high", old, none)),
        F.when((status == "operating") & (age >= 1.5), flag("routine_refresh_due", "low", old, none)),
        F.when((status == "proposed") & (planned < F.year(today) - 1), flag("planned_start_slipped", "medium", none, planned)),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())
