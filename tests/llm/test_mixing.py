"""Mixing against plain code: shares, streams, permutations, slots, words taken."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
import xxhash
from gaugeworks.llm import mixing
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = "doc_id long, text string, source string, size int, rank string"


def h(*values):
    """Spark's xxhash64."""
    seed = 42
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def i32(v):
    return (v, 4)


def i64(v):
    return (v, 8)


def permuted(x, n, key):
    prime = next(p for p in mixing.PRIMES if n % p)
    for r in range(mixing.ROUNDS):
        x = (x * prime + h(i64(key), i32(2 * r)) % n) % n
        other = (h(i64(key), i32(2 * r + 1)) % n - x) % n
        if h(i32(r), i64(key), i64(max(x, other))) & 1:
            x = other
    return x


def targets(sizes, weights, cap):
    """Shares by hand: all by weight, then again what is above the cap, until nothing is."""
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    done, words = {}, Fraction(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in done]
        left, all_weight = words - sum(done.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / all_weight for s in free}
        over = {s: Fraction(cap * sizes[s]) for s in free if share[s] >= cap * sizes[s]}
        if not over:
            return order, done | share
        done |= over


def brute(rows, mix):
    """(doc_id, size, source_size, target, taken) of every row."""
    own = [(i, t or "", s) for i, t, s in rows]
    sizes = Counter()
    for _, t, s in own:
        sizes[s] += len(WORD.findall(t))
    order, target = targets(dict(sizes), mix.weights, mix.cap)
    out, total_slots, before, plans = [], 0, {}, {}
    for s in order:
        blocks = -(-sizes[s] // mix.block_words)
        n = min(mix.cap * blocks, int(float(target[s]) * blocks / sizes[s] + 0.5)) if sizes[s] else 0
        before[s], total_slots, plans[s] = total_slots, total_slots + n, (blocks, n)
    for rank, s in enumerate(order):
        blocks, n = plans[s]
        uses = Counter()
        for slot in range(n):
            key = h(i32(mix.seed), "blocks", i64(rank), i32(slot // blocks))
            uses[permuted(slot % blocks, blocks, key)] += 1
        buckets = mixing.BUCKETS
        mine = []
        for i, t, source in own:
            if source == s:
                d = [None if i is None else i64(i), i64(h(t)), i64(len(WORD.findall(t)))]
                mine.append((h(*d) % buckets, (i is not None, i or 0), h(t), len(WORD.findall(t)), i))
        at = 0
        for _, _, _, size, i in sorted(mine, key=lambda m: m[:4]):
            got = sum(uses[p // mix.block_words] for p in range(at, at + size))
            out.append((str(i), size, sizes[s], float(target[s]), got))
            at += size
    return sorted(out)


def some_rows(n, seed):
    pick = random.Random(seed)
    rows = [(i, " ".join(["w"] * pick.choice([0, 1, 3, 10, 40, 41])), pick.choice(["hot"] * 6 + ["b", "é", "Z", "", None, "src10", "src9"])) for i in range(n)]
    rows += [(None, None, None), (None, "no id", "b"), (5, "again and again", "b"), (5, "again and again", "b"), (5, "another text", "b"), (900, "\n\t ", "no words"), (901, " a\x0bb\x0cc\rd ", "tiny"), (902, "x " * 3000, "one long")]
    return rows


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix((7, 1), 2, 5, 64, 3), mixing.Mix((1,), 1, 16, 10, 4)])
def test_taken_is_that_of_plain_code(spark, mix):
    rows = some_rows(300, 1)
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], KINDS)
    got = sorted((str(r.doc_id), r.size, r.source_size, r.target, r.taken) for r in mixing.taken(df, mix).collect())
    want = brute(rows, mix)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(abs(g[3] - w[3]) <= 1e-9 * max(1, w[3]) for g, w in zip(got, want, strict=True))
    assert all(g[4] <= mix.cap * g[1] for g in got)
    again = mixing.taken(df.repartition(7), mix)
    assert sorted((str(r.doc_id), r.size, r.source_size, r.target, r.taken) for r in again.collect()) == got


def test_the_mix_has_full_shards_whose_texts_are_the_words_taken(spark):
    mix = mixing.Mix(block_words=8, shard_slots=50)
    rows = [(i, " ".join(f"{s}{i}_{k}" for k in range(n)), s) for i, n, s in [(i, random.Random(i).randint(0, 30), "abc"[i % 3 if i % 2 else 0]) for i in range(150)]]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], KINDS)
    out = mixing.mixed(df, mix).collect()
    places = sorted((r.shard, r.place) for r in out)
    assert places == [(i // 50, i % 50) for i in range(len(out))]
    seen = Counter(w for r in out for w in r.text.split(" "))
    for r in mixing.taken(df, mix).collect():
        assert sum(n for w, n in seen.items() if w[1:].split("_")[0] == str(r.doc_id)) == r.taken
    assert max(seen.values()) <= 3
    whole = {s: " ".join(w for _, t, source in rows if source == s for w in t.split()) for s in "abc"}
    assert all(len(r.text.split(" ")) == 8 for r in out if len(r.text.split(" ")) != len(whole[r.source].split()) % 8)
    sized = mixing.sizes(df)
    shared = mixing.shares(sized, mix)
    counts = Counter({(r.shard, r["rank"]): r.n for r in mixing.shard_counts(mixing.slots(shared, mix), mix).collect()})
    for s in shared.collect():
        own = [n for (_, rank), n in counts.items() if rank == s["rank"]]
        assert sum(own) == s.slots
    share = max(s.slots for s in shared.collect()) / len(out)
    full = [max(n for (k, _), n in counts.items() if k == shard) for shard in range(len(out) // 50)]
    assert all(abs(n - 50 * share) < 5 * (50 * share) ** 0.5 for n in full) and len(set(full)) > 1


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 256, 1000, 200_006])
def test_permutations_hit_every_place_once(spark, n):
    out = spark.range(n)
    for k in (1, 2):
        out = mixing.permuted(out, f"k{k}", F.col("id"), F.lit(n).cast("long"), F.lit(k).cast("long"))
    out = out.orderBy("id").collect()
    for k in ("k1", "k2"):
        assert sorted(r[k] for r in out) == list(range(n))
    if n >= 97:
        assert [r.k1 for r in out] != [r.k2 for r in out]
        assert sum(abs(a.k1 - b.k1) for a, b in zip(out, out[1:])) / n > n / 6  # neighbours go far apart


def test_empty_and_wordless_tables(spark):
    none = spark.createDataFrame([], KINDS)
    assert mixing.taken(none).count() == 0 and mixing.mixed(none).count() == 0
    blank = spark.createDataFrame([(1, "", "a", 1, ""), (2, None, None, 1, "")], KINDS)
    assert sorted(tuple(r)[:5] for r in mixing.taken(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
