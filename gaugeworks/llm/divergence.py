"""Source divergence audit: how far each source's use of terms is from every other source's and from its language's.

1. Every task counts the terms of its texts by (lang, source), with the documents they are in, and hands on
   its sums (`counted`). They are added up by term; a language keeps the terms of at least `documents` of its
   documents.
2. Terms are dealt to slices of some thousand, and a group's counts in one slice are a sparse vector (`vectors`):
   no task ever holds a whole vocabulary, and a hot source's vector is no longer than its language's. While
   a vector is packed, a heap finds its leading terms against the language as a whole.
3. Sources sit in seats of `seat` groups. A seat's vectors of a slice stay in one partition; packed copies of
   the other seats' go round a ring, in round r to the seat r places on, for half of a turn, so that every two
   seats meet once, and each meeting is evaluated in both directions (`meetings`). All rounds are one shuffle,
   sorted by round within a partition, so that a task holds its residents and one visitor.
4. Sums over slices, ranks by window.

Arithmetic is in whole numbers. With c occurrences of a term among the N of its group and V kept terms in the
language, p = 1 + floor(10^9 (c + 1) / (N + V)); the divergence of p from q is the sum over all kept terms
of floor((p - q)^2 / q). Terms that neither group has are all alike and counted, not visited.

Null text, lang and source count as ''. A group without kept terms has its pairs; a language without kept
terms has value 0 for all pairs. Very long texts are counted whole. Ties in rank go by the item's UTF-8
bytes. Repeated rows are documents of their own. An empty table gives an empty result. Only text, lang and source
are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import small_batches, written

#: Counts that a task gathers before it hands them on.
HELD = 300_000
SCALE_STEPS, STEP = 3, 1000  # 10^9 in steps that keep remainders of counts up to 10^15 within 64 bits
LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes of a term (letters in lower case, all of other scripts) as they are, others to blanks.
TERM_BYTES = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in LETTERS else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of letters A-Z, in lower case, and characters beyond ASCII. All bytes of such a character are beyond ASCII too."""
    return text.encode("utf-8").translate(TERM_BYTES).split()


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): sums of a task's documents, and a row with a null term for each group it met."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (words, docs_with) in held.items():
            names = [None, *words]
            counts, docs_of = [0, *words.values()], [0, *(docs_with[w] for w in words)]
            for at in range(0, len(names), 50_000):
                own = slice(at, at + 50_000)
                m = len(names[own])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * m), pa.array([source] * m), pa.array(names[own], pa.binary()).cast(pa.string()), pa.array(counts[own], pa.int64()), pa.array(docs_of[own], pa.int64())], ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in small_batches(batches, 2):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                own, before = terms(text), len(words)
                words.update(own)
                docs_with.update(set(own))
                size += len(words) - before
            if size > HELD:
                yield from rows(held)
                held, size = {}, 0
        yield from rows(held)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    read = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    return read.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_terms(sums: DataFrame, documents: int = 3) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the terms a language keeps, and a row with a null term for each group; first: one row of each term. Written."""
    added = sums.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # a row for each source; the partitioning is that of the sums
    whole = added.select("*", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"), F.min("source").over(term).alias("least"))
    kept = whole.filter(F.col("term").isNull() | (F.col("lang_docs") >= documents))
    first = (F.col("term").isNotNull() & (F.col("source") == F.col("least"))).cast("int")
    return written(kept.select("lang", "source", "term", "n", "lang_n", first.alias("first")), "divergence-kept")


def groups(kept: DataFrame, seat: int) -> DataFrame:
    """(lang, source, total, v, lang_total, idx, seats) for every group: a row of numbers each. Written."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    lang = Window.partitionBy("lang")
    idx = (F.row_number().over(lang.orderBy("source")) - 1).alias("idx")
    seats = F.ceil(F.count("*").over(lang) / seat).cast("int").alias("seats")
    return written(sums.select("lang", "source", "total", F.sum("firsts").over(lang).alias("v"), F.sum("total").over(lang).alias("lang_total"), idx, seats), "divergence-groups")


def share(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / whole), exact: long division, as counts may be large. whole is at least each count + 1."""
    left = counts.astype(np.int64) + 1
    out, left = left // whole, left % whole
    for _ in range(SCALE_STEPS):
        left = left * STEP
        out, left = out * STEP + left // whole, left % whole
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def leading(term: list[str], n: np.ndarray, lang_n: np.ndarray, total: int, v: int, lang_total: int, top: int) -> list[tuple[int, bytes]]:
    """(-value, term) of the terms that the group has more of than its language, the `top` first of them."""
    if not len(n):
        return []
    p, q = share(n, total + v), share(lang_n, lang_total + v)
    value = np.where((n > 0) & (p > q), distance(p, q), -1)
    least = max(0, np.partition(value, -top)[-top]) if len(value) > top else 0
    return heapq.nsmallest(top, ((-int(value[i]), term[i].encode("utf-8")) for i in np.flatnonzero(value >= least)))


def pack(ids: np.ndarray, n: np.ndarray) -> bytes:
    """A sparse vector with rising ids: steps between ids, then counts, compressed."""
    return zlib.compress(np.diff(ids, prepend=0).astype("<i4").tobytes() + n.astype("<i8").tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(packed)
    size = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, "<i4", size)), np.frombuffer(raw, "<i8", size, 4 * size).astype(np.int64)


def vectors(kept: DataFrame, known: DataFrame, slices: int, top: int) -> DataFrame:
    """(lang, source, idx, seats, total, v, slice, packed, heap): each group's vector in each slice, also where it is empty, and its leading terms there. Written."""
    slice_of = F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int")
    inside = Window.partitionBy("lang", "slice").orderBy("term")  # some thousand terms
    named = kept.filter("first = 1").select("lang", "term", slice_of.alias("slice")).withColumn("id", F.row_number().over(inside) - 1)
    found = kept.filter("term IS NOT NULL").join(named, ["lang", "term"]).select("lang", "source", "slice", F.struct("id", "n", "lang_n", "term").alias("entry"))
    none = F.lit(None).cast(found.schema["entry"].dataType)
    empty = known.select("lang", "source", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), none.alias("entry"))
    listed = found.unionByName(empty).groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    entry = lambda name: F.transform("entries", lambda e: e[name]).alias(name)
    rows = listed.join(known, ["lang", "source"]).select("lang", "source", "idx", "seats", "total", "v", "lang_total", "slice", *[entry(c) for c in ("id", "n", "lang_n", "term")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                numbers = lambda c: np.array(row.column(c)[0].values.to_numpy(zero_copy_only=False), np.int64)  # noqa: B023, E731
                ids, n, lang_n = (numbers(c) for c in ("id", "n", "lang_n"))
                total, v, lang_total = (row.column(c)[0].as_py() for c in ("total", "v", "lang_total"))
                best = leading(row.column("term")[0].as_py(), n, lang_n, total, v, lang_total, top)
                heap = pa.array([[{"item": t.decode("utf-8"), "value": -x} for x, t in best]], pa.list_(pa.struct([("item", pa.string()), ("value", pa.int64())])))
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("lang", "source", "idx", "seats", "total", "v", "slice")), pa.array([pack(ids, n)], pa.binary()), heap], ["lang", "source", "idx", "seats", "total", "v", "slice", "packed", "heap"])

    schema = "lang string, source string, idx int, seats int, total long, v long, slice int, packed binary, heap array<struct<item: string, value: long>>"
    return written(rows.mapInArrow(run, schema), "divergence-vectors")


def both_ways(a: tuple, b: tuple) -> tuple[int, int, int]:
    """Sums of a's divergence from b and of b's from a over the terms that one of them has, and how many these are. Each is (ids, p, p of a term it lacks)."""
    (ids, p, p_none), (other_ids, q, q_none) = a, b
    if len(other_ids):
        at = np.minimum(np.searchsorted(other_ids, ids), len(other_ids) - 1)
        hit = other_ids[at] == ids
        q_here = np.where(hit, q[at], q_none)
        alone = np.ones(len(other_ids), bool)
        alone[at[hit]] = False
        rest = q[alone]
    else:
        q_here, rest = np.full(len(ids), q_none), q
    forth = distance(p, q_here).sum() + distance(p_none, rest).sum()
    back = distance(q_here, p).sum() + distance(rest, p_none).sum()
    return int(forth), int(back), len(ids) + len(rest)


def meetings(held: DataFrame, seat: int) -> DataFrame:
    """(lang, a, b, value, union): for every two groups of a language and each slice, a's divergence from b over the terms that one of them has."""
    own = F.floor(F.col("idx") / seat).cast("int")
    rounds = F.sequence(F.lit(0), F.floor(F.col("seats") / 2).cast("int"))
    sent = held.select("lang", "slice", "idx", "seats", "total", "v", "packed", own.alias("seat"), F.explode(rounds).alias("round"))
    # on an even ring two seats that face each other would meet twice in the last round
    sent = sent.filter((F.col("round") * 2 < F.col("seats")) | (F.col("seat") * 2 < F.col("seats")))
    host = ((F.col("seat") + F.col("round")) % F.col("seats")).alias("host")
    dealt = sent.select("lang", "slice", host, "round", "idx", "total", "v", "packed").repartition("lang", "slice", "host").sortWithinPartitions("lang", "slice", "host", "round", "idx")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, residents = None, []
        for batch in batches:
            out: list[tuple] = []
            for lang, part, host, turn, idx, total, v, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, part, host) != place:
                    place, residents = (lang, part, host), []
                ids, n = unpack(packed)
                whole = max(1, total + v)
                mine = (ids, share(n, whole), share(np.zeros(1, np.int64), whole)[0])
                for other, theirs in residents:
                    forth, back, union = both_ways(theirs, mine)
                    out += [(lang, other, idx, forth, union), (lang, idx, other, back, union)]
                if turn == 0:
                    residents.append((idx, mine))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    return dealt.mapInArrow(meet, "lang string, a int, b int, value long, union long")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    lang, *numbers = zip(*out, strict=True)
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(lang), *(pa.array(c, k) for c, k in zip(numbers, kinds, strict=True))], ["lang", "a", "b", "value", "union"])


def audit(docs: DataFrame, documents: int = 3, top: int = 200, seat: int = 8, slice_terms: int = 8192, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): in part `pair` all other sources of the language, in part `term` the `top` terms the source has more of than its language."""
    kept = kept_terms(counted(docs, text_col, lang_col, source_col), documents)
    known = groups(kept, seat)
    slices = max(1, -(-int(known.agg(F.max("v")).first()[0] or 0) // slice_terms))
    held = vectors(kept, known, slices, top)
    met = meetings(held, seat).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("union").alias("union"))
    lacked = F.expr("1 + 1000000000 div greatest(1, total + v)")
    side = lambda n: known.select("lang", F.col("idx").alias(n), F.col("source").alias(f"{n}_source"), "v", lacked.alias(f"{n}_none"))
    pairs = met.join(side("a").drop("v"), ["lang", "a"]).join(side("b"), ["lang", "b"])
    alike = F.expr("(v - union) * ((a_none - b_none) * (a_none - b_none) div b_none)")
    pairs = pairs.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), (F.col("value") + alike).alias("value"))
    best = held.select("lang", "source", F.lit("term").alias("part"), F.inline("heap"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = best.select("*", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= top)
    return pairs.select("*", F.row_number().over(order).alias("rank")).unionByName(ranked)
