"""Byte-pair encoding and decoding by batched numpy merge rounds.

`encode` and `decode` give what the tokenizers library gives for a word vocabulary: NFC, white space to
blanks, lower case, words by pattern, bytes as symbols, `</w>` on a word's last symbol, merges by rank.
The words of a batch that the worker has not met are put one behind the other in one flat array of
symbols; each round finds every adjacent pair's rank by binary search in the sorted pair keys, merges
the lowest-ranked pair of each word and drops the words that have no pair left.

Null text: as the empty text (no ids, empty decoding). Very long texts are encoded whole, very long words too. Ties: of
pairs of one rank in a word the first is merged first. Repeated rows: each has its row. An empty table:
an empty result. Other columns of the input are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches

#: Words kept per worker.
KEPT, LONGEST = 700_000, 48
#: White space of the vocabulary's patterns (Unicode's White_Space). Python's own classes have four controls more.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_NO_RANK = np.int64(1) << 40


def byte_letters() -> list[str]:
    """A printable letter for each byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def lowered(text: str) -> str:
    """Lower case letter by letter: a final sigma is not special."""
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


class WordBPE:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = special
        self.cut = regex.compile("|".join(regex.escape(x) for x in sorted(special, key=len, reverse=True))) if special else None
        self.tokens: dict[int, str] = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        key = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        self.known: dict[str, bytes] = {}

    def merge(self, words: list[str]) -> list[bytes]:
        """Each word's ids, by merge rounds over all words at once."""
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        byte = np.frombuffer(b"".join(raw), np.uint8)
        sym, word = self.inner[byte], np.repeat(np.arange(len(raw)), size)
        closing = np.cumsum(size)[size > 0] - 1
        sym[closing] = self.last[byte[closing]]
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            pair = (sym[:-1] << 20) | sym[1:]
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.full(len(sym), _NO_RANK)
            rank[:-1] = np.where((self.key[at] == pair) & (word[1:] == word[:-1]), self.rank[at], _NO_RANK)
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            ended = best == _NO_RANK
            if ended.any():
                done_sym.append(sym[ended])
                done_word.append(word[ended])
            hit = np.flatnonzero((rank == best) & ~ended)
            if len(hit) > 1:  # of overlapping hits (aaa) every other one, from the left
                run = np.concatenate(([True], np.diff(hit) != 1))
                begin = np.flatnonzero(run)
                hit = hit[(np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))) % 2 == 0]
            sym = sym.copy()
            sym[hit] = self.made[at[hit]]
            left = ~ended
            left[hit + 1] = False
            sym, word = sym[left], word[left]
        if not done_sym:
            return [b""] * len(words)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        flat = sym[order].astype("<u4").tobytes()
        edge = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words))))) * 4
        return [flat[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]

    def _pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        return self.words.findall(lowered(self.spaces.sub(" ", unicodedata.normalize("NFC", text))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null is the empty text."""
        known, chunks, missing = self.known, [], set()
        for text in texts:
            own = text.split(" ") if text else []
            chunks.append(own)
            missing.update([c for c in own if c not in known])
        missing.discard("")
        new = {"": b""}
        if missing:
            cut = {c: self._cut(c) for c in missing}
            words = sorted({w for parts in cut.values() for p in parts if isinstance(p, list) for w in p})
            ids = dict(zip(words, self.merge(words), strict=True))
            for c, parts in cut.items():
                new[c] = b"".join(b"".join(map(ids.__getitem__, p)) if isinstance(p, list) else int(p).to_bytes(4, "little") for p in parts)
        out = [b"".join([known.get(c) or new.get(c, b"") for c in own]) for own in chunks]
        room = KEPT - len(known)
        if room > 0:
            known.update([(k, v) for k, v in new.items() if len(k) <= LONGEST][:room])
        return out

    def _cut(self, chunk: str) -> list[list[str] | int]:
        """Lists of words, and ids of special tokens between them."""
        if self.cut is None or "<" not in chunk:
            return [self._pieces(chunk)]
        out: list[list[str] | int] = []
        at = 0
        for m in self.cut.finditer(chunk):
            out += [self._pieces(chunk[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return [*out, self._pieces(chunk[at:])]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, as the vocabulary has no decoder; unknown ids give nothing."""
        get = self.tokens.get
        try:
            return " ".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return " ".join(t for t in map(get, ids) if t is not None)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    """The worker's encoder; it lives as long as the worker."""
    return WordBPE(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in small_batches(batches):
            found = bpe.encode(batch.column(1).to_pylist())
            edge = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
            flat = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded text) for every row of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            text = [bpe.decode([i for i in ids if i is not None] if ids else []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["id", "decoded"])

    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return df.mapInArrow(run, "id long, decoded string").withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass, so that ids need not travel between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in small_batches(batches):
            count, by_ids, by_text = [], [], []
            for raw in bpe.encode(batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, "<u4").tolist()
                count.append(len(ids))
                by_ids.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                by_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
