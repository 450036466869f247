"""Encoding, packing and the token store against the library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from gaugeworks.llm import bpe, packing, token_store
from gaugeworks.llm.encoder import ChunkEncoder
from gaugeworks.llm.shared import new_folder
from tokenizers import Tokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "Hello  world", " a", "a ", "x\n y", "it's DON'T we'LL", "aaa aaaaaaa", "x<|endoftext|> y <|startoftext|><|endoftext|>z", "ΣΑΣ İstanbul ſ K", "éa ́b", "日本語 テスト 123", "😀😀 x", "a <|endoftext|>b", "x" * 3000, "a \n\n b", "don't' 's ''s", "word.' word.'s x!'ll"]
LETTERS = "aAbBeE \n\t.,'!<|>sStdm0é́Σσ日 "


def some_texts(n: int) -> list[str | None]:
    pick = random.Random(3)
    return ODD + ["".join(pick.choice(LETTERS) for _ in range(pick.randint(1, 60))) for _ in range(n)]


#: Control, format and blank-like characters anywhere in a text.
CONTROL = ["\0", "\x01", "\x1c", "\x1f", "\x7f", "\x80", "\x85", "\xa0", "\xad", "\u200b", "\u200d", "\ufeff", "\u3000", "\u0301", "\ufffd", "\u202e", "\x0b", "\x0c", "\r", "\n", "<|endoftext|>", " ", " ", " ", "a", "The", "don't", "12", ".", "!?", "é", "日"]


def control_texts(n: int) -> list[str | None]:
    pick = random.Random(8)
    return ["a \0bc", "\0", " \0", "\0 \0a"] + ["".join(pick.choice(CONTROL) for _ in range(pick.randint(1, 14))) for _ in range(n)]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_librarys_ids(path):
    texts = some_texts(1500) + control_texts(3000)
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoder = ChunkEncoder(path)
    for _ in range(2):  # once new, once known
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_merge_rounds_give_the_librarys_ids_and_decoding(spark):
    texts = some_texts(400) + control_texts(400)
    library = Tokenizer.from_file(WORD)
    want = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoded = bpe.encode(rows(spark, texts), WORD)
    assert {r.doc_id: list(r.ids) for r in encoded.collect()} == dict(enumerate(want))
    assert {r.doc_id: r.decoded for r in bpe.decode(encoded, WORD).collect()} == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(want)}
    for r in bpe.round_trip_digests(rows(spark, texts), WORD).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want[r.doc_id], skip_special_tokens=False).encode()).hexdigest()


def test_empty_tables(spark):
    none = rows(spark, ["x"]).filter("false")
    assert bpe.round_trip_digests(none, WORD).count() == 0
    assert packing.pack(none, BYTE, 0, 64).count() == 0
    assert token_store.digests(none, token_store.write_store(none, new_folder(spark, "store"), WORD, 2)).count() == 0


@pytest.mark.parametrize("shard_ids", [40, 8_000_000])
def test_store_gives_back_every_document_by_key(spark, shard_ids):
    texts = some_texts(300)
    ids = [7 * i - 900 for i in range(len(texts))]
    table = [(i, t) for i, t in zip(ids, texts)] + [(None, "no key"), (None, None), (-(2**63), "the least key"), (2**63 - 1, "the greatest")]
    table += [(ids[5], f"the same key again {i % 40}") for i in range(120)]  # one key in many shards, with repeated rows
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    store = token_store.write_store(df, new_folder(spark, "store"), WORD, end_id=2, keys_per_bucket=100, shard_ids=shard_ids)
    assert store.buckets > 1
    library = Tokenizer.from_file(WORD)
    at = 0
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in table]
    found = sorted((r.start, -(2**64) if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.digests(df, store).collect())
    assert len(found) == len(table)
    by_key = {}
    for k, x in encoded:
        by_key.setdefault(-(2**64) if k is None else k, []).append((len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    got_by_key = {}
    for start, key, n, crc in found:
        assert start == at
        at += n
        got_by_key.setdefault(key, []).append((n, crc))
    assert list(got_by_key) == sorted(by_key)
    assert {k: sorted(v) for k, v in got_by_key.items()} == {k: sorted(v) for k, v in by_key.items()}
    some = spark.createDataFrame([(ids[5],), (ids[7],), (ids[7],), (None,), (10**9,)], "doc_id long")
    read = token_store.read_ids(token_store.locate(some, store), store).collect()
    assert sorted((str(r.key), list(r.ids)) for r in read) == sorted((str(k), x) for k, x in encoded if k in (ids[5], ids[7], None))
    foreign = spark.createDataFrame([(10**9 + i,) for i in range(500)], "doc_id long")
    assert token_store.locate(foreign, store).count() == 0


def test_reading_in_runs():
    start, n = np.array([0, 10, 15, 50_000, 50_010]), np.array([10, 5, 1, 10, 5_000_000])
    assert list(token_store.runs(start, n)) == [(0, 3), (3, 4), (4, 5)]
    assert list(token_store.runs(start[:0], n[:0])) == []


def test_wide_ids_and_perfect_places(tmp_path):
    token_store.write_shard(f"file://{tmp_path}/shard-00000.bin", [np.array([70000, 1], "<u4").tobytes(), b""])
    shard = token_store.Shard(f"file://{tmp_path}/shard-00000.bin")
    assert shard.width == 4 and shard.lengths().tolist() == [2, 0] and shard.ids(0, 2).tolist() == [70000, 1]
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 20000))
    assert sorted(token_store.PerfectHash.build(keys).place(keys)) == list(range(len(keys)))


def test_packing_loses_nothing_and_overlaps_nothing(spark):
    pick = random.Random(4)
    texts = [" ".join(pick.choice(["alpha", "beta", "12", "x"]) for _ in range(pick.choice([0, 3, 20, 30, 31, 60, 200, 700]))) for _ in range(400)] + ["same text here"] * 300 + [None]
    library = Tokenizer.from_file(BYTE)
    df = rows(spark, texts)
    out = packing.assign(packing.written(packing.pieces(df, BYTE, 0, 64), "pieces"), 64, rows_per_group=40).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    bins, seen = {}, {}
    for r in out:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.length == 64 or r.piece == 0
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, ids in want.items():
        own = sorted(seen[i])
        assert [p[0] for p in own] == list(range(len(own))) and sum(p[2] for p in own) == len(ids)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
        assert sum(3 * length > 64 for _, length in own) <= 2
    assert len(bins) <= 1.02 * -(-sum(map(len, want.values())) // 64) + 2


def test_plan_pairs_large_pieces_greedily():
    runs, bins = packing.plan({6: 2, 4: 2, 5: 2, 1: 1}, 10)
    assert bins == 4 and sum(r[2] for r in runs) == 7
    assert packing.plan({}, 10) == ([], 0)
