"""Fill-in-middle: texts cut into units and put in another order, so that a model learns to fill gaps.

A unit grammar is one class of characters that ends a unit and one that begins the next; it is translated to
a regex of zero width that looks behind for the one and ahead for the other, and Spark's `split` at this
regex keeps every character of the text. Two draws of a keyed digest of the document's id say where prefix
and middle end, a third whether the text is changed at all and a fourth in which order.

Forms: plain (the text), psm (prefix, suffix, middle) and spm (suffix, prefix, middle), each part behind its
mark. A text that holds a mark stays plain, so that `restore` gives the exact text back from output and form.

Null text counts as the empty text, which has no unit and stays plain (a split would give one empty unit). A
null id counts as the empty text in the digest. Very long texts are cut whole. There are no ties. Repeated
rows, and different rows of one id, have the same draws and each its own row. An empty table gives an empty
result. Only id and text are read, so names of other columns can't clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import GAP, NOT_GAP, text_or_empty

#: Unit grammars: (class of a unit's last character, class of the next one's first).
UNITS = {
    "word": (NOT_GAP, GAP),  # white space goes with the word behind it
    "line": (r"\n", r"[\x00-\x{10FFFF}]"),
    "sentence": (r"[.!?]", GAP),
    "clause": (r"[.!?,;:]", GAP),
}


@dataclass(frozen=True)
class Plan:
    """Shares in percent: `rate` of the texts are changed, `spm` of these get the suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def boundary(before: str, after: str) -> str:
    """The zero-width place between a character of one class and one of another."""
    return f"(?<={before})(?={after})"


def units(text: Column, grammar: str = "word") -> Column:
    """A text's units in order; they join to the text. The empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(*UNITS[grammar]), -1))


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, plan: Plan = Plan(), grammar: str = "word", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008  frozen
    """(id, text, n, form, prefix, middle, suffix, output); the three parts are null in plain rows."""
    marked = F.lit(False)
    for mark in (plan.prefix, plan.suffix, plan.middle):
        marked = marked | F.contains("text", F.lit(mark))
    drawn = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select("*", *[h.alias(f"h{i}") for i, h in enumerate(draws("id", plan.seed), 1)])
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= plan.rate)
    cut = drawn.select("*", units(F.col("text"), grammar).alias("units"), F.when(plain, "plain").when(F.col("h4") % 100 < plan.spm, "spm").otherwise("psm").alias("form"))
    n = F.size("units")
    ends = cut.select("id", "text", "units", "form", n.alias("n"), F.least(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).cast("int").alias("a"), F.greatest(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).cast("int").alias("b"))
    part = lambda start, size: F.when(F.col("form") != "plain", F.array_join(F.slice("units", start, size), ""))
    parts = ends.select("id", "text", F.col("n").cast("long").alias("n"), "form", part(F.lit(1), F.col("a")).alias("prefix"), part(F.col("a") + 1, F.col("b") - F.col("a")).alias("middle"), part(F.col("b") + 1, F.col("n") - F.col("b")).alias("suffix"))
    psm = F.concat(F.lit(plan.prefix), "prefix", F.lit(plan.suffix), "suffix", F.lit(plan.middle), "middle")
    spm = F.concat(F.lit(plan.suffix), "suffix", F.lit(plan.prefix), "prefix", F.lit(plan.middle), "middle")
    return parts.withColumn("output", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))).withColumnRenamed("id", id_col)


def restore(output: Column, form: Column, plan: Plan = Plan()) -> Column:  # noqa: B008  frozen
    """The text that an output of this form was made of, read from the output alone."""
    between = lambda a, b: F.split_part(F.split_part(output, F.lit(a), F.lit(2)), F.lit(b), F.lit(1))
    behind = lambda a: F.split_part(output, F.lit(a), F.lit(2))
    psm = F.concat(between(plan.prefix, plan.suffix), behind(plan.middle), between(plan.suffix, plan.middle))
    spm = F.concat(between(plan.prefix, plan.middle), behind(plan.middle), between(plan.suffix, plan.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id") -> DataFrame:  # noqa: B008  frozen
    """Counts and digests of the outputs and of the texts restored from them."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return transform(df, plan, id_col=id_col).select(
        id_col,
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restore(F.col("output"), F.col("form"), plan)).alias("restored_sha256"),
    )


def rule_sql(plan: Plan = Plan()) -> tuple[str, str]:  # noqa: B008  frozen
    """The digest's and the marks' part of the plan as SQL: what is hashed, and whether a text holds a mark."""
    marks = " OR ".join(f"contains(text, '{m}')" for m in (plan.prefix, plan.suffix, plan.middle))
    if not re.fullmatch(r"[^']*", plan.prefix + plan.suffix + plan.middle):
        raise ValueError("marks with quotes can't be put in SQL text")
    return f"sha256('{plan.seed}:' || coalesce(CAST(doc_id AS VARCHAR), ''))", marks
