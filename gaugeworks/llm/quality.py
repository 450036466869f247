"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

`RULES` says what a document must keep to. `measure` adds the counts, `judge` turns the table into one
boolean column. Null text counts as the empty text: all counts are 0, `base_failed` is true and `kept`
false. Very long texts are
counted whole. There are no ties. Repeated rows are judged one by one; an empty table gives an empty result; columns of the input
that carry a name used here are not read, and only the columns named below are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import GAP, NOT_GAP, text_or_empty

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = {
    "en": "the be to of and a in that is it for with as was on are by this from at or an not have he his they we you which what with than",
    "fr": "le la les de des du et en un une que qui est dans pour sur au aux pas par avec il elle ce se sont plus",
    "de": "der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an werden aus er hat dass",
    "es": "el la los las de del y en un una que es por con para se lo su al como más no son",
}
STOP = sorted({w for words in STOP_WORDS.values() for w in words.split()})


@dataclass(frozen=True)
class Rule:
    """A document of at least `words` words fails if 1000 * part `op` limit * whole."""

    name: str
    part: str
    whole: str
    op: str
    limit: int
    words: int = 0


#: The threshold table; limits are per mille, in whole numbers, so that every engine decides alike.
RULES = (
    Rule("mean_word_short", "word_chars", "n_words", "<", 2000),
    Rule("mean_word_long", "word_chars", "n_words", ">", 14000),
    Rule("symbols", "n_symbols", "n_words", ">", 300),
    Rule("stop_words", "n_stop_words", "n_words", "<", 40, 30),
    Rule("same_lines", "n_dup_lines", "n_lines", ">", 400),
)


def _hits(windows: Column) -> Column:
    """How many words lie in 5-word windows that occur twice or more; windows: their hashes by place."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    bound = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  a name for a value that is used often
    twice = lambda s: F.filter(s, lambda p, i: (p.h == F.get(s, i - 1).h).eqNullSafe(True) | (p.h == F.get(s, i + 1).h).eqNullSafe(True))
    places = bound(pairs, lambda s: F.sort_array(F.transform(twice(s), lambda p: p.i)))
    return bound(places, lambda a: F.aggregate(F.transform(a, lambda p, i: F.when(i == 0, 5).otherwise(F.least(F.lit(5), p - F.get(a, i - 1)))), F.lit(0), lambda t, x: t + x))


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines) for every row."""
    inner = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    split = (
        df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
        .withColumn("inner", inner)
        .select("id", "text", F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(F.split("inner", GAP + "+", -1)).alias("words"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NOT_GAP)).alias("lines"))
    )
    at = lambda i, k: F.get("words", i + k)
    n = F.size("words")
    windows = F.when(n >= 5, F.transform(F.slice("words", F.lit(1), n - 4), lambda w, i: F.xxhash64(w, at(i, 1), at(i, 2), at(i, 3), at(i, 4)))).otherwise(F.array().cast("array<bigint>"))
    stops = F.filter("words", lambda w: F.lower(w).isin(STOP))
    counted = split.select(
        "id",
        n.alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.size(stops).alias("n_stop_words"),
        windows.alias("windows"),
    )
    repeats = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(_hits(F.col("windows")))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return counted.select(F.col("id").alias(id_col), *[F.col(c).cast("long").alias(c) for c in names], repeats.cast("long").alias("n_repeat_words"), F.col("n_stop_words").cast("long").alias("n_stop_words"), F.col("n_lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def failed(rule: Rule) -> Column:
    part, whole = 1000 * F.col(rule.part), rule.limit * F.col(rule.whole)
    return (F.col("n_words") >= rule.words) & ((part < whole) if rule.op == "<" else (part > whole))


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds base_failed, failed_rules (names, in the table's order) and kept."""
    names = F.filter(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return measured.withColumns({"base_failed": base_failed(), "failed_rules": names}).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def rule_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The table's verdict as SQL: true if a rule fails."""
    return " OR ".join(f"(n_words >= {r.words} AND 1000 * {r.part} {r.op} {r.limit} * {r.whole})" for r in rules)


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that keep to the base and to every rule, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    judged = judge(measure(df.select(row.alias("row"), F.col(f"`{text_col}`").alias("text")), "row", "text"))
    # not a filter: the optimizer would push it below the counts and split each text anew for every use of its words
    kept = F.explode(F.when(F.col("kept"), F.array("row")).otherwise(F.array().cast(judged.select(F.array("row")).schema[0].dataType)))
    return judged.select(kept.alias("row")).select(*[F.col("row").getField(c).alias(c) for c in df.columns])
