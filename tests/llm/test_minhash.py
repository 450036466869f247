"""Near duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re

import pytest
from gaugeworks.llm import minhash
from gaugeworks.llm.components import components


def brute(rows, size, percent):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        own = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
        sets[i] = own
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus():
    pick = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    words = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    passage = words(60)
    texts = [" ".join(words(pick.choice([1, 2, 3, 5, 30, 120]))) for _ in range(60)]
    center = words(140)
    for k in range(170):  # a crowd of near copies, from hardly to strongly changed
        own = list(center)
        for _ in range(pick.choice([0, 1, 2, 3, 4, 6, 9])):
            own[pick.randrange(140)] = pick.choice(vocabulary[:40])
        texts.append(" ".join(own))
    texts += [" ".join(passage + words(pick.choice([5, 12, 60]))) for _ in range(90)]
    texts += [texts[3]] * 40 + [texts[70].upper(), "  " + texts[71].replace(" ", "\t\n") + " "]
    texts += ["", None, " \n", "one", "ONE", "one two", "x" * 30000]
    pick.shuffle(texts)
    return [(10 * i - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, size, percent, monkeypatch):
    monkeypatch.setattr(minhash, "PIVOTS", 8)  # so that this small crowd counts as long lists
    rows = corpus()
    df = spark.createDataFrame([(i, t, "n", 3) for i, t in rows], "doc_id long, text string, node string, fp int").repartition(3)
    want = brute(rows, size, percent)
    got = {r.doc_id: r for r in minhash.near_duplicates(df, size, percent).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = minhash.keep_one(df, size=size, percent=percent)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_null_and_repeated_ids(spark):
    same = " ".join(f"w{k}" for k in range(40))
    rows = [(None, same), (None, same), (5, same), (5, same), (9, same + " end"), (None, "quite another text of its own here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(False, 5, 5, True), (False, 5, 5, True), (False, 9, 5, False), (True, 0, 0, True), (True, 0, 0, True), (True, 0, 5, False), (True, 0, 5, False)]
    assert sorted((r.doc_id or 0) for r in minhash.keep_one(df).collect()) == [0, 0, 0, 0, 5]


def test_each_text_of_a_repeated_or_null_id_has_its_own_links(spark):
    text = lambda c: " ".join(f"{c}{k}" for k in range(40))
    rows = [(5, text("a")), (5, text("b")), (8, text("a") + " end"), (9, text("b") + " end"), (3, text("b") + " more"), (12, text("c") + " end"), (None, text("c")), (None, text("d")), (None, text("d") + " end"), (20, text("e")), (20, "")]
    for order in (rows, rows[::-1]):
        got = minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3)).collect()
        assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 0, True), (0, 12, False), (3, 3, True), (5, 3, False), (5, 3, False), (8, 3, False), (9, 3, False), (12, 12, True), (20, 20, True), (20, 20, True)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.keep_one(none).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, "")], "doc_id long, text string")
    assert sorted(minhash.near_duplicates(blank).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, i) for i in range(201, 260)] + [(300 + i, 300 + (i + 1) % 17) for i in range(17)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 1 for i in range(1, 61)) and all(got[i] == 200 for i in range(200, 260)) and all(got[300 + i] == 300 for i in range(17))
