"""Fill-in-middle against plain code over code points, and its SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from gaugeworks.llm import fill_middle, queries

SMALL = "/root/testdata/sf0.001"
TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", None, " ", "\n\n", "a", " a", "a ", "a\x0bb \x0c\r c", "a b c d", "😀 😀😀\t😀", "x <P> y z", "<S>", "a <M", "< <S <P < S> a b c d e", "é \0 x\x00 y", "日本 語　テスト x", "w " * 9000]


def draws(key):
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def brute(key, text):
    text = text or ""
    own = TOKENS.findall(text)
    h = draws(key)
    a, b = sorted((h[0] % (len(own) + 1), h[1] % (len(own) + 1)))
    prefix, middle, suffix = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, out, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h[3] % 100 < 80 else "psm"
        out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
        sizes = (len(prefix), len(middle))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (str(key), len(own), form, *sizes, sha(out), sha(text))


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, units string, h1 int")


def test_rows_are_those_of_plain_code(spark):
    pick = random.Random(5)
    texts = [t for t in ODD for _ in range(6)] + ["".join(pick.choice("ab<PSM>  \n\t\x0bé日😀 ") for _ in range(pick.randint(0, 40))) for _ in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (7, "one id again"), (7, "one id again"), (-5, "a b c")]
    got = sorted(str((str(r.doc_id), *r[1:])) for r in fill_middle.digests(table(spark, rows)).collect())
    assert got == sorted(str(brute(*r)) for r in rows)
    assert {"psm", "spm", "plain"} == {eval(g)[2] for g in got}
    assert fill_middle.digests(table(spark, rows).filter("false")).count() == 0


@pytest.mark.parametrize("name, grammar", [("word", TOKENS), ("line", re.compile(r"[^\n]*\n|[^\n]+")), ("sentence", re.compile(r"(?s).+?(?:[.!?](?=[\x20\x09-\x0D])|$)"))])
def test_split_at_boundaries_gives_the_units_of_the_grammar(spark, name, grammar):
    texts = [t or "" for t in ODD] + ["One. Two! Three?\nFour", "a.b. c.. d\n\n\ne"]
    rows = table(spark, list(enumerate(texts))).select("doc_id", fill_middle.units(fill_middle.F.col("text"), name).alias("u")).collect()
    for r in rows:
        assert "".join(r.u) == texts[r.doc_id]
        if name != "sentence" or not texts[r.doc_id].endswith("\n"):
            assert r.u == grammar.findall(texts[r.doc_id])


def test_sql_gives_the_rows_of_the_query(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    out = queries.op12_fill_middle(spark, SMALL)
    assert sorted(map(tuple, out.collect())) == sorted(con.sql(queries.OP12).fetchall())
