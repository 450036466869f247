"""The divergence audit against plain code on whole numbers, and its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from gaugeworks.llm import divergence, queries

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = "text string, lang string, source string, term string, n int, idx string"


def brute(rows, top):
    counts, whole, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in ([x or "" for x in r] for r in rows):
        own = TERM.findall(text.translate(UPPER))
        counts[lang, source].update(own)
        docs[lang].update(set(own))
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= 3) for lang, _ in counts}
    for (lang, _), c in counts.items():
        whole[lang].update(c)
    share = lambda c, lang: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept[lang]) + len(kept[lang])) for t in kept[lang]}
    p, q = {g: share(c, g[0]) for g, c in counts.items()}, {lang: share(c, lang) for lang, c in whole.items()}
    f = lambda x, y: (x - y) ** 2 // y
    out = []
    for lang, source in counts:
        mine = p[lang, source]
        pairs = [(-sum(f(mine[t], p[lang, other][t]) for t in kept[lang]), other.encode()) for la, other in counts if la == lang and other != source]
        best = [(-f(mine[t], q[lang][t]), t.encode()) for t in kept[lang] if counts[lang, source][t] and mine[t] > q[lang][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def some_rows(n, sources, seed):
    pick = random.Random(seed)
    letters = ["the", "The", "THE", "über", "ÜBER", "a_b", "日本", "x1y", "don't", "é", "zz\0top", "😀", "ß", "\x7f", "K"] + [f"w{c}{d}" for c in "abcde" for d in "fghij"]
    rows = [(" ".join(pick.choice(letters[i % 7 :]) for _ in range(pick.randint(0, 12))), pick.choice(["en", "en", "de", "", None]), f"s{pick.randrange(sources)}") for i in range(n)]
    rows += [(None, None, None), ("", "xx", "a"), (None, "xx", "b"), ("one two", "xx", "c"), ("the the the", "en", "hot"), ("the " * 4000, "en", "hot")] + [("wa wb", "en", "s1")] * 4
    return [(*r, "clash", 1, "clash") for r in rows]


@pytest.mark.parametrize("sources, seat, slice_terms, top", [(1, 8, 8192, 200), (7, 2, 5, 4), (10, 3, 12, 7), (13, 1, 1, 200)])
def test_rows_are_those_of_plain_code(spark, sources, seat, slice_terms, top):
    rows = some_rows(260, sources, sources)
    out = divergence.audit(spark.createDataFrame(rows, KINDS), seat=seat, slice_terms=slice_terms, top=top)
    assert sorted(map(tuple, out.collect())) == brute([r[:3] for r in rows], top)


def test_every_two_seats_meet_once(spark):
    for seats in range(1, 10):
        rows = [("en", f"{i:02d}", i, seats, 1, 1, 0, divergence.pack(np.array([0]), np.array([1])), []) for i in range(seats)]
        held = spark.createDataFrame(rows, "lang string, source string, idx int, seats int, total long, v long, slice int, packed binary, heap array<string>")
        met = Counter((r.a, r.b) for r in divergence.meetings(held, 1).collect())
        assert met == Counter({(a, b): 1 for a in range(seats) for b in range(seats) if a != b})


def test_shares_are_exact_for_large_counts():
    pick = random.Random(2)
    for _ in range(300):
        whole = pick.randint(1, 9 * 10**15)
        counts = [pick.randint(0, whole - 1) for _ in range(5)] + [0, whole - 1]
        assert divergence.share(np.array(counts), whole).tolist() == [1 + 10**9 * (c + 1) // whole for c in counts]


def test_vectors_come_back():
    ids, n = np.unique(np.random.default_rng(1).integers(0, 9000, 500)), None
    n = np.random.default_rng(2).integers(0, 2**60, len(ids))
    for a, b in ((ids, n), (ids[:0], n[:0])):
        got = divergence.unpack(divergence.pack(a, b))
        assert got[0].tolist() == a.tolist() and got[1].tolist() == b.tolist()


def test_terms_are_those_of_the_pattern():
    for c in [*range(0x250), 0x3000, 0x1F600]:
        text = f"A{chr(c)}b {chr(c)} C"
        assert [t.decode() for t in divergence.terms(text)] == TERM.findall(text.translate(UPPER))


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], KINDS)).count() == 0


def test_sql_gives_the_rows_of_the_query(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert sorted(map(tuple, queries.op13_divergence(spark, SMALL).collect())) == sorted(con.sql(queries.OP13).fetchall())
