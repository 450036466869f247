"""The pipeline against a brute-force version of each stage, and odd inputs."""

from __future__ import annotations

import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from gaugeworks.llm import minhash, nbsvm, queries, secret_scan
from tokenizers import Tokenizer

from .test_minhash import brute

SMALL = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, owner = docs.columns, {r.doc_id: r.source for r in docs.collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    good = {r[0] for r in con.sql(queries.OP3).fetchall() if r[-1]}
    one = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == good
    two = corpus_pipeline.quality_classifier(spark, one, SMALL)
    model = nbsvm.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = {}
    for r in one.collect():
        score = model.scores(model.margins(*nbsvm.features([r.text])))[0]
        if score >= 0.3:
            kept[r.doc_id] = r.text
    assert two.columns == columns and {r.doc_id for r in two.collect()} == set(kept)
    groups = brute(list(kept.items()), 5, 80)
    left = {i: t for i, t in kept.items() if groups[i][1] == i}
    three = corpus_pipeline.near_duplicates(spark, two, SMALL)
    assert three.columns == columns and {r.doc_id for r in three.collect()} == set(left)
    found = {i: secret_scan.base_spans(t) for i, t in left.items()}
    found = {i: sorted(b + secret_scan.added_spans(left[i], [(x[0], x[2]) for x in b])) for i, b in found.items()}
    owners: dict[str, set] = {}
    for i, spans in found.items():
        for s in spans:
            owners.setdefault(s[3], set()).add(owner[i])
    cut = {}
    for i, text in left.items():
        out, at = "", 0
        for a, _, b, value in found[i]:
            if len(owners[value]) < secret_scan.OWNERS:
                if a >= at:
                    out += text[at:a] + "<secret>"
                at = max(at, b)
        cut[i] = out + text[at:]
    four = corpus_pipeline.secrets(spark, three, SMALL)
    assert four.columns == columns
    assert {r.doc_id: (r.text, r.n_chars) for r in four.collect()} == {i: (t, len(t)) for i, t in cut.items()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in cut.items()}
    placed, total = {}, dict.fromkeys(ids, 0)
    for r in corpus_pipeline.run(spark, SMALL).collect():
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total[r.doc_id] += r.length
    assert total == {i: len(x) for i, x in ids.items()}
    for own in placed.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_take_nulls_and_empty_tables(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, "en", "s", 0), (None, "the cat sat on the mat and it is of the best " * 2, None, None, None), (3, "x" * 50000, "en", "s", 50000)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, kinds)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns and out.count() <= len(table)
        assert corpus_pipeline.pack(spark, docs, SMALL).count() >= len(table)


def test_one_of_each_group_stays_with_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, __id string, __row int, keep map<string,int>"
    rows = [(1, text, "a", 1, {"x": 1}), (1, text, "a", 1, {"x": 1}), (2, text + " end", "b", 2, {}), (3, "other words here", "c", 3, None), (None, text, "d", 4, {"y": 2})]
    out = minhash.keep_one(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "__id", "__row", "keep"]
    got = sorted((str(r.doc_id), r["__id"], r["__row"], r.keep) for r in out.collect())
    assert got == [("1", "a", 1, {"x": 1}), ("3", "c", 3, None), ("None", "d", 4, {"y": 2})]
