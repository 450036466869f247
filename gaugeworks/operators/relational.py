"""Joins, rollups and orderings that denormalise asset tables; every function takes and gives DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..sources.flat import checkpointed


def with_lookups(df: DataFrame, lookups: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Left joins to lookup tables: column -> (table, its key, the column to take). Spark broadcasts those that its statistics show to be small."""
    for col, (table, key, take) in lookups.items():
        name = f"{col}_{take}"
        df = df.join(table.select(F.col(key).alias("__key"), F.col(take).alias(name)), F.col(col) == F.col("__key"), "left").drop("__key")
    return df


def latest_by(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order. Give a total order, so that the choice is the same each time."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")


def grouped_lists(df: DataFrame, key: str, order: list[str], take: list[str], name: str) -> DataFrame:
    """(key, name): the rows of a key as an ordered array of structs."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in take if c not in order]))).alias(name))


def ordered_lists(df: DataFrame, key: str, order: list[Column], take: list[str], name: str) -> DataFrame:
    """(key, name): the rows of a key as an array of structs in any order of columns, such as a share that falls with nulls last. Give a total order."""
    placed = df.withColumn("__at", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    listed = placed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__at", F.struct(*take).alias("row")))).alias("rows"))
    return listed.select(key, F.transform("rows", lambda x: x.row).alias(name))


def named_ids(df: DataFrame, key: str, ids: str, lookup: DataFrame, lookup_key: str, lookup_name: str) -> DataFrame:
    """(key, names): the names of a JSON list of ids, in its order, joined by commas; what is no id, and ids without a name, are left out, what is no list gives ''."""
    listed = F.from_json(F.col(ids), "array<string>")
    each = df.select(key, F.posexplode(listed).alias("__at", "__text")).withColumn("__id", F.col("__text").try_cast("bigint")).filter("__id IS NOT NULL")
    known = lookup.select(F.col(lookup_key).cast("bigint").alias("__id"), F.col(lookup_name).alias("__name")).filter("__name <> ''")
    told = each.join(known, "__id").groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", "__name"))), lambda x: x["__name"]), ", ").alias("names"))
    return df.select(key).join(told, key, "left").select(key, F.coalesce("names", F.lit("")).alias("names"))


def by_level(plants: DataFrame, owners: DataFrame, flag: str, plant_key: str, unit_key: str) -> DataFrame:
    """Level switch: a plant's own rows where its flag is set, else its units' rows. An owner row with both keys counts for the plant."""
    of_plant = owners.filter(F.col(plant_key).isNotNull())
    of_unit = owners.filter(F.col(plant_key).isNull()).drop(plant_key)
    first = plants.filter(flag).join(of_plant.drop(unit_key), plant_key, "left")
    second = plants.filter(~F.coalesce(F.expr(flag), F.lit(False))).join(of_unit, unit_key, "left")
    return first.unionByName(second, allowMissingColumns=True)


def resolve_refs(df: DataFrame, key: str, refs: str, sources: DataFrame, source_id: str = "id", url: str = "url", sep: str = ", ") -> DataFrame:
    """(key, refs_text): an array of source ids as their addresses, in order, repeats kept, unknown ids left out; '' for none."""
    each = df.select(key, F.posexplode(refs).alias("pos", "ref")).join(sources.select(F.col(source_id).alias("ref"), F.col(url).alias("url")), "ref").filter(F.coalesce(F.col("url"), F.lit("")) != "")
    text = each.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "url"))), lambda x: x.url), sep).alias("refs_text"))
    return df.select(key).join(text, key, "left").select(key, F.coalesce("refs_text", F.lit("")).alias("refs_text"))


def back_references(df: DataFrame, key: str, points_at: str, name: str) -> DataFrame:
    """df with an array of the keys of the rows that point at each row."""
    back = df.filter(F.col(points_at).isNotNull()).groupBy(F.col(points_at).alias(key)).agg(F.sort_array(F.collect_list(key)).alias(name))
    return df.join(back, key, "left").withColumn(name, F.coalesce(name, F.array().cast(dict(back.dtypes)[name])))


def ultimate_parents(seeds: DataFrame, edges: DataFrame, tops: DataFrame) -> DataFrame:
    """(start, parent, share): every path from a company up its owners to one that has none, is marked a top, or closes a circle.

    seeds (company); edges (company, owner, share: null counts as 100); tops (company): those marked. One row a path.
    Edges without company or owner are left out. One join a level, each level written before the next.
    """
    known = edges.filter("company IS NOT NULL AND owner IS NOT NULL").select("company", "owner", F.coalesce(F.col("share").cast("decimal(18,6)"), F.lit(100).cast("decimal(18,6)")).alias("part"))
    ends = lambda df, col: df.join(known.select(F.col("company").alias(col), F.lit(True).alias("__up")).distinct(), col, "left").join(tops.select(F.col("company").alias(col), F.lit(True).alias("__top")).distinct(), col, "left").withColumn("ended", F.col("__up").isNull() | F.col("__top").isNotNull()).drop("__up", "__top")
    up = checkpointed(ends(known, "owner").withColumnRenamed("ended", "is_end"))
    front = ends(seeds.filter("company IS NOT NULL").select(F.col("company").alias("at")), "at")
    kind = dict(front.dtypes)["at"]
    front = checkpointed(front.select(F.col("at").alias("start"), "at", F.lit(100).cast("decimal(38,12)").alias("share"), F.array().cast(f"array<{kind}>").alias("path"), "ended"))
    done = [front.filter("ended")]
    while not (front := front.filter("NOT ended")).isEmpty():
        path = F.array_append("path", F.col("at"))
        step = front.join(up, F.col("at") == F.col("company")).select("start", F.col("owner").alias("at"), (F.col("share") * F.col("part") / 100).cast("decimal(38,12)").alias("share"), path.alias("path"), (F.col("is_end") | F.array_contains(path, F.col("owner"))).alias("ended"))
        front = checkpointed(step)
        done.append(front.filter("ended"))
    return reduce(DataFrame.unionByName, done).select("start", F.col("at").alias("parent"), "share")


def rounded_totals(units: DataFrame, key: str, kind: str, value: Column, cost: Column) -> DataFrame:
    """(key, import_total, export_total, cost_total): values rounded one by one before they are summed; a total of 0 is null, and so is a cost never seen."""
    one = F.round(value, 2)
    total = lambda k: F.nullif(F.sum(F.when(F.lower(kind) == k, one)), F.lit(0)).alias(f"{k}_total")
    return units.groupBy(key).agg(total("import"), total("export"), F.sum(cost).alias("cost_total"))


def upsert(prior: DataFrame, now: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """A list rolled forward: non-empty new values overwrite, `keep` columns hold their first value, rows of either side stay."""
    a, b = prior.alias("a"), now.alias("b")
    joined = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    full = lambda c: F.when(c.cast("string") != "", c)
    out = []
    for c in dict.fromkeys([*prior.columns, *now.columns]):
        old = F.col(f"a.{c}") if c in prior.columns else F.lit(None)
        new = F.col(f"b.{c}") if c in now.columns else F.lit(None)
        out.append((F.coalesce(full(old), full(new)) if c in keep else F.coalesce(full(new), full(old))).alias(c))
    return joined.select(*out)


def runs(df: DataFrame, part: list[str], order: str, value: str) -> DataFrame:
    """Runs of equal neighbours: (part, run, value, first, last, n)."""
    w = Window.partitionBy(*part).orderBy(order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = df.withColumn("__new", new).withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*part, "run").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def agreement(df: DataFrame, key: str, columns: list[str], project: float = 0.95, unit: float = 0.30) -> DataFrame:
    """(field, groups, agreeing, level): of keys with several rows, how many agree on a field, and the level that makes it."""
    counts = df.groupBy(key).agg(F.count("*").alias("__n"), *[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns]).filter("__n > 1")
    each = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), (F.col(c) <= 1).cast("int").alias("same")) for c in columns])).alias("x")).select("x.*")
    share = F.col("agreeing") / F.col("groups")
    level = F.when(share >= project, "project").when(share <= unit, "unit").otherwise("mixed")
    return each.groupBy("field").agg(F.count("*").alias("groups"), F.sum("same").alias("agreeing")).withColumn("level", level)


def compose(units: DataFrame, plants: DataFrame, key: str, both: dict[str, tuple[str | None, str | None]], unit_first: bool = True, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """One wide row a unit: each column from the unit or its plant, the first that is not empty in the order given.

    both: column -> (its column of the unit, of the plant; None where that side has none). Units without plant go. A
    limit is one on plants, taken in `order` before their units are joined.
    """
    chosen = plants if limit is None else plants.orderBy(*(order or [key])).limit(limit)
    u = units.select(*[F.col(c).alias(f"u_{c}") for c in units.columns])
    p = chosen.select(*[F.col(c).alias(f"p_{c}") for c in plants.columns])
    full = lambda side, c: F.when(F.col(f"{side}_{c}").cast("string") != "", F.col(f"{side}_{c}").cast("string"))

    def value(unit: str | None, plant: str | None) -> Column:
        sides = [full("u", unit)] if unit else []
        sides = sides + ([full("p", plant)] if plant else [])
        return F.coalesce(*(sides if unit_first else sides[::-1]), F.lit(""))

    return u.join(p, F.col(f"u_{key}") == F.col(f"p_{key}")).select(*[value(a, b).alias(name) for name, (a, b) in both.items()])


def companies_of(links: DataFrame, companies: DataFrame, key: str = "company_id") -> DataFrame:
    """Owner or operator links with their company's columns; links without company go."""
    return links.join(companies, key)


def parent_homes(texts: DataFrame, key: str, text: str, companies: DataFrame, ids: Column, home: str = "country") -> DataFrame:
    """(key, homes): the countries of the companies that a text's ids name, in order, each mention. companies: id, home."""
    each = texts.select(key, F.posexplode(ids).alias("pos", "id")).join(companies.select("id", home), "id")
    told = each.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", home))), lambda x: x[home]), "; ").alias("homes"))
    return texts.select(key).join(told, key, "left").select(key, F.coalesce("homes", F.lit("")).alias("homes"))


def conversions(units: DataFrame, replacements: DataFrame, prefix: str = "G") -> DataFrame:
    """(unit, kind, from_ids, to_ids): what a unit replaced or was converted from, and what later replaced it or was converted from it.

    units: unit, converted, converted_from; replacements: unit, replaces. A known conversion beats replacements.
    """
    ids = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: F.concat(F.lit(prefix), x.cast("string"))), ", ")
    before = replacements.filter("replaces IS NOT NULL").groupBy("unit").agg(ids("replaces").alias("old"))
    changed = units.filter("converted AND converted_from IS NOT NULL").select("unit", F.col("converted_from").alias("source"))
    later = replacements.filter("replaces IS NOT NULL").select(F.col("replaces").alias("unit"), F.col("unit").alias("next")).unionByName(changed.select(F.col("source").alias("unit"), F.col("unit").alias("next")))
    after = later.groupBy("unit").agg(ids("next").alias("to_ids"))
    out = units.select("unit").join(before, "unit", "left").join(changed, "unit", "left").join(after, "unit", "left")
    kind = F.when(F.col("source").isNotNull(), "conversion").when(F.col("old").isNotNull(), "replacement").otherwise("")
    return out.select("unit", kind.alias("kind"), F.coalesce(F.concat(F.lit(prefix), F.col("source").cast("string")), F.col("old"), F.lit("")).alias("from_ids"), F.coalesce("to_ids", F.lit("")).alias("to_ids"))


def taken_once(pairs: DataFrame) -> DataFrame:
    """(match, row, unit_name): within a match, rows in order take the first unit by unit_row that no earlier row took. pairs: match, row, unit_row, unit_name."""
    first = F.filter("__pairs", lambda p: F.lit(False))
    took = lambda out, p: F.exists(out, lambda x: (x.row == p.row) | (x.unit_name == p.unit_name))
    listed = pairs.filter("row IS NOT NULL").groupBy("match").agg(F.sort_array(F.collect_list(F.struct("row", "unit_row", "unit_name"))).alias("__pairs"))
    out = F.aggregate("__pairs", first, lambda out, p: F.when(took(out, p), out).otherwise(F.array_append(out, p)))
    return listed.select("match", F.explode(out).alias("x")).select("match", "x.row", "x.unit_name")


def running_sum(df: DataFrame, order: list[str], value: str, to: str) -> DataFrame:
    """df with `to`, the sum of `value` over all rows before, in a total order: by range partitions, within each and over their totals."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("__part").agg(F.sum(value).alias("__all"))  # a row for each partition
    starts = parts.select("__part", F.coalesce(F.sum("__all").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__from"))
    own = dealt.withColumn(to, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(F.broadcast(starts), "__part").withColumn(to, F.col(to) + F.col("__from")).drop("__part", "__from")


def containments(inner: DataFrame, outer: DataFrame, place: list[str], inner_col: str, outer_col: str, length: int = 8) -> DataFrame:
    """Rows of inner beside the rows of outer, of the same place, whose text holds theirs.

    An inner text is looked up by the stretch of `length` letters of it that the fewest outer texts hold (a shorter
    text by itself), so that a common beginning makes no crowd. Outer texts are cut into stretches of those lengths
    alone that inner texts ask for. Empty inner texts are in no other text.
    """
    own = inner.select(*place, inner_col).distinct().filter(F.length(inner_col) > 0)
    lengths = own.agg(F.collect_set(F.least(F.length(inner_col), F.lit(length))).alias("__lengths"))  # one row of `length` numbers at most
    held = checkpointed(outer.select(*place, outer_col).distinct().crossJoin(F.broadcast(lengths)))
    cut = F.flatten(F.transform(F.filter("__lengths", lambda n: n <= F.length(outer_col)), lambda n: F.transform(F.sequence(F.lit(1), F.length(outer_col) - n + 1), lambda i: F.substring(F.col(outer_col), i, n))))
    parts = held.select(*place, outer_col, F.explode(F.array_distinct(cut)).alias("__x"))
    often = parts.groupBy(*place, "__x").agg(F.count("*").alias("__n"))
    last = F.greatest(F.length(inner_col) - length + 1, F.lit(1))
    asked = own.select(*place, inner_col, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(F.col(inner_col), i, length)))).alias("__x"))
    counted = asked.join(often, [*place, "__x"], "left")
    rarest = counted.groupBy(*place, inner_col).agg(F.min_by("__x", F.struct("__n", "__x")).alias("__x"), F.count_if(F.col("__n").isNull()).alias("__missing")).filter("__missing = 0").drop("__missing")
    met = rarest.join(parts, [*place, "__x"]).drop("__x").filter(F.col(outer_col).contains(F.col(inner_col)))
    return met.join(inner, [*place, inner_col]).join(outer, [*place, outer_col])
