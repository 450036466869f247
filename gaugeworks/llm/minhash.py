"""Near duplicates by bottom-k sketches of one hash function.

1. A document's set: the hashes of its distinct shingles. Documents with equal sets form a class; a
   class is a node of the graph, named by its least doc_id whose least set it is, or beyond all ids
   (NO_ID and up, by its hash) if it has none. Classes that share a doc_id are linked.
2. A class's sketch: the k least hashes of its set. If two sets' similarity reaches the threshold,
   their sketches share at least `least_overlap` values but for a chance under 1e-6 at the threshold
   itself and far less above (short sets: certainly, as the sketch is the set).
3. Inverted lists: value -> classes. By the pigeonhole rule two sketches that share t of their values
   share one among the first size - t + 1 of each in any common order; in the order of rising
   frequency these are the rare ones, so that widely shared passages make no lists. Values of one
   class only take places in that order but make no list.
4. Candidates from the lists, without pairs of copies: in the first round each list ties its members
   to the member whose values are shared most; what verifies is joined to components. From then on a
   list counts only while it spans several components. Short lists are held against themselves. A long
   list is a crowd of strongly changed copies or of texts around one passage. Its members get exact
   lists: all shingles of their full sets in the order of rising frequency, each with the number of
   shingles from its place on, which bounds what a pair that first meets there can share. That leaves
   few in a crowd, as those near the middle are one component and those far out meet nobody in time.
   What still makes a long list is worked off in turns, a quarter of it against the rest, so every
   pair of different components that share a list is compared in the end.
5. The union of two sketches is itself the sketch of the union; the share of its k least values that
   both have estimates the similarity and drops candidates far below. The rest are confirmed on their
   full sets, counted exactly.

Null and empty texts, and texts without words: empty set, linked with nothing. Repeated rows: rows of one
doc_id with words are of one component, whatever their texts; each row is returned. Null doc_id: component_id is the least doc_id of its class or
component if there is one, else null, and kept is true only if there is none. Very long texts: sets of all their
shingles. Ties: of equally rare values the smaller, of equally near members the one that compares greatest; neither
changes the components. Empty tables: empty result.
Ids are below 2**62. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .encoder import forget
from .shared import by_frequency, salted, small_batches, written
from .words import shingle_sets, split_words

K = 64
#: Members that a list holds against its others in one round: at least so many, and a quarter of a long list.
PIVOTS = 64
NO_ID = 2**62


def least_overlap(threshold: float, k: int = K) -> int:
    """Five deviations and a bit under the expected number of shared values of two sketches at the threshold."""
    return max(1, math.floor(k * threshold - 5.2 * math.sqrt(k * threshold * (1 - threshold))))


def _sketches(df: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, n_shingles, fp, sketch) for every row; hash: of the text, fp: a 128-bit hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches):
            sets = shingle_sets(split_words(batch.column(1).to_pylist()), size)
            fp = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            n = pa.array([len(s) for s in sets], pa.int64())
            edge = np.concatenate(([0], np.cumsum([min(K, len(s)) for s in sets]))).astype(np.int32)
            flat = np.concatenate([s[:K] for s in sets]).view(np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), n, pa.array(fp, pa.binary()), sketch], ["id", "hash", "n_shingles", "fp", "sketch"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "id long, hash long, n_shingles long, fp binary, sketch array<long>")


def _prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(node, n, weight, fp, values): the rare values of each sketch, of those that several classes have. weight: how widely the node's values are shared."""
    t = least_overlap(percent / 100)
    size = F.size("sketch")
    exact = F.ceil(F.lit(percent) * F.col("n") / 100).cast("int")  # of sets that are their own sketch, and whose partners are
    need = F.when(F.col("n") * 100 <= percent * K, F.greatest(exact, F.lit(1))).otherwise(F.lit(t))
    values = classes.select("node", F.explode("sketch").alias("value"))
    often = written(values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    seen = by_frequency(values, often, "value", "df").groupBy("node").agg(F.sum("df").alias("weight"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("seen"))
    own = seen.join(classes.select("node", "n", "fp", (size - need + 1).alias("room"), size.alias("size")), "node")
    left = F.col("room") - (F.col("size") - F.size("seen"))
    return own.filter(left > 0).select("node", "n", "weight", "fp", F.transform(F.slice("seen", F.lit(1), left), lambda x: x.value).alias("values"))


def _could_link(percent: int) -> Column:
    """Whether two sets of n and m shingles, own and own_m of them not alone, can reach the threshold."""
    common = F.least("own", "own_m")
    return 100 * common >= percent * (F.col("n") + F.col("m") - common)


def _of_nodes(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of a wide table that written pairs name: a small list of nodes is broadcast, so the table isn't shuffled for a few."""
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return table.join(written(nodes, "nodes"), "node", "left_semi")


def _confirmed(pairs: DataFrame, sketches: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs (u, v) of nodes those whose sets reach the threshold, written. With sketches these estimate first."""
    least = percent / 100 - 5.2 * math.sqrt(percent / 100 * (1 - percent / 100) / K)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            one, two = ((c.values.to_numpy().view(np.uint64), c.offsets.to_numpy()) for c in (batch.column(2), batch.column(3)))
            for i in range(batch.num_rows):
                x, y = one[0][one[1][i] : one[1][i + 1]], two[0][two[1][i] : two[1][i + 1]]
                both = np.sort(np.concatenate((x, y)))
                twice = np.flatnonzero(both[1:] == both[:-1])
                union = len(both) - len(twice)
                if union > K:  # of the union's K least, those that are there twice
                    distinct = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
                    last = both[distinct[K - 1]]
                    keep[i] = np.count_nonzero(both[twice] <= last) >= least * K
                else:
                    keep[i] = len(twice) >= least * union
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], ["u", "v"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (batch.column(2), batch.column(3)))
                both = np.sort(np.concatenate((x, y)))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], ["u", "v"])

    def beside(some: DataFrame, table: DataFrame, col: str) -> DataFrame:
        own = _of_nodes(table, some).select("node", col)
        one = salted(some, own.toDF("u", "a"), "u")  # a middle of many lists is in very many pairs
        return salted(one, own.toDF("v", "b"), "v", some).select("u", "v", "a", "b")

    pairs = written(pairs, "pairs")
    if sketches is not None:
        pairs = written(beside(pairs, sketches, "sketch").mapInArrow(estimate, "u long, v long"), "likely")
    return written(beside(pairs, sets, "shingles").mapInArrow(confirm, "u long, v long"), "links")


def _exact_lists(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(value, node, n, own): the rarest shingles of each node's full set that two of the nodes have; own: shingles from there on."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
                size = [len(x) for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), size)), pa.array(np.repeat(size, size)), pa.array(np.concatenate(own))], ["node", "n", "value"])

    each = written(sets.join(nodes, "node", "left_semi").select("node", "shingles").mapInArrow(shingles, "node long, n long, value long"), "shingles")
    often = written(each.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    own = by_frequency(each, often, "value", "df").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("seen"))
    alone = F.col("n") - F.size("seen")
    room = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - alone
    listed = own.filter(room > 0).select("node", "n", alone.alias("alone"), F.posexplode(F.slice("seen", F.lit(1), room.cast("int"))).alias("pos", "x"))
    return listed.select(F.col("x.value").alias("value"), "node", "n", (F.col("n") - F.col("alone") - F.col("pos")).alias("own"))


def near_duplicates(df: DataFrame, size: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: documents linked where 100 * shared >= percent * union of their shingles."""
    rows = written(_sketches(df, size, id_col, text_col), "sketches")
    with_words = rows.filter("fp IS NOT NULL")
    # ids with several sets are few: each belongs to its least set, and its other sets are linked with that one
    several = with_words.filter("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("own"), F.max("fp").alias("last")).filter("own <> last").select("id", "own")
    several = written(several, "several")
    # rows without id stay out of the join, which would bring them all to one task
    named = with_words.filter("id IS NOT NULL").join(several, "id", "left").withColumn("named", F.when(F.col("own").isNull() | (F.col("own") == F.col("fp")), F.col("id"))).drop("own")
    named = named.unionByName(with_words.filter("id IS NULL").withColumn("named", F.col("id")))
    node = F.coalesce(F.min("named"), F.lit(NO_ID) + F.pmod(F.xxhash64("fp"), F.lit(2**62)))
    # the text that a class's full set is read from, by its least id and its hash
    text = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("text")
    classes = written(named.groupBy("fp").agg(node.alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), text), "classes")
    listed = written(_prefixes(classes, percent), "listed")
    sets = written(_full_sets(df, listed.join(classes.select("node", "text"), "node"), size, id_col, text_col), "sets")
    of = lambda fp, name: classes.select(F.col("fp").alias(fp), F.col("node").alias(name))
    tied = with_words.select("id", "fp").join(several, "id").filter("fp <> own").select("fp", "own").distinct()
    links = _Links(sets, percent, tied.join(of("fp", "u"), "fp").join(of("own", "v"), "own").select("u", "v"))
    lists = listed.select("node", "n", F.col("n").alias("own"), F.col("node").alias("component"), "weight", F.explode("values").alias("value"))
    links.add(links.pairs(lists, _middle(lists, "weight")), classes)
    links.settle()
    lists = links.spanning(lists)
    short = lists.filter(F.col("members") <= PIVOTS)
    links.add(links.pairs(short, short.select("value", *_as_pivot())), classes)
    long = lists.filter(F.col("members") > PIVOTS)
    if not long.isEmpty():
        lists = links.spanning(_exact_lists(sets, long.select("node").distinct(), percent))
        links.add(links.pairs(lists, _middle(lists, "own")))
        links.settle()
        lists = links.spanning(lists)
        while not lists.isEmpty():
            # a turn's members are held against all others of their list and leave it
            turn = F.pmod(F.xxhash64("value", "node"), F.col("members")) < F.greatest(F.lit(PIVOTS), F.floor(F.col("members") / 4))
            turn = turn | (F.col("members") <= PIVOTS)
            new = links.add(links.pairs(lists, lists.filter(turn).select("value", *_as_pivot())))
            lists = lists.filter(~turn)
            if lists.isEmpty():
                break
            if new:
                links.settle()
            lists = links.spanning(lists)
    links.settle()
    return _labelled(rows, classes, links.label, id_col)


def _as_pivot() -> list[Column]:
    return [F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("own").alias("own_m"), F.col("component").alias("side")]


def _middle(lists: DataFrame, by: str) -> DataFrame:
    """Of each list the member that most of the others are likely near to."""
    top = lists.groupBy("value").agg(F.max(F.struct(by, *_as_pivot())).alias("top"), F.count("*").alias("count"))
    return top.select("value", "top.pivot", "top.m", "top.own_m", "top.side", "count")


class _Links:
    """The links confirmed so far, and the components of those that are settled."""

    def __init__(self, sets: DataFrame, percent: int, tied: DataFrame):
        self.sets, self.percent = sets, percent
        self.edges = written(tied, "tied")
        self.label: DataFrame | None = None
        self.fresh = True

    def pairs(self, lists: DataFrame, pivots: DataFrame) -> DataFrame:
        met = by_frequency(lists, written(pivots, "middles"), "value", "count") if "count" in pivots.columns else salted(lists, pivots, "value")
        near = met.filter((F.col("component") != F.col("side")) & _could_link(self.percent))
        return near.select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")).distinct()

    def add(self, pairs: DataFrame, sketches: DataFrame | None = None) -> bool:
        """Confirm pairs and keep their links; whether there are any."""
        found = _confirmed(pairs, sketches, self.sets, self.percent)
        if found.isEmpty():
            return False
        self.edges, self.fresh = self.edges.unionByName(found), True
        return True

    def settle(self) -> None:
        if self.fresh:
            self.label, self.fresh = written(components(self.edges), "labels"), False

    def spanning(self, lists: DataFrame) -> DataFrame:
        """The lists that span several components, without members that no other of their list could link with, and with their number of members; written."""
        named = lists.drop("component", "members").join(self.label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = written(named, "named")
        least = written(named.groupBy("value").agg(F.min("n").alias("m"), F.count("*").alias("count")), "least")
        far = F.greatest(F.col("m"), F.ceil(self.percent * F.col("n") / 100))
        near = by_frequency(named, least, "value", "count").filter(100 * F.col("own") >= self.percent * (F.col("n") + far - F.col("own"))).drop("m", "count")
        near = written(near, "near")
        spans = near.groupBy("value").agg(F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("value", "members")
        return written(by_frequency(near, written(spans, "spans"), "value", "members"), "lists")


def _full_sets(df: DataFrame, listed: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the classes that have lists, each from one text, that of its least id and its hash. Texts without id are told by their hash alone, after copies are put together."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    wanted = listed.select(F.col("text.id").alias("id"), F.col("text.hash").alias("hash"), "node", "fp")
    named = docs.join(wanted.filter("id IS NOT NULL"), ["id", "hash"])
    # repeated rows are dropped before their sets are made
    named = named.select("node", "text", "fp").dropDuplicates(["node", "fp"])
    nameless = docs.filter("id IS NULL").groupBy("hash").agg(F.first("text").alias("text"))
    nameless = nameless.join(wanted.filter("id IS NULL").drop("id"), "hash")
    texts = named.unionByName(nameless.select("node", "text", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches):
            sets = shingle_sets(split_words(batch.column(1).to_pylist()), size)
            raw = [s.tobytes() for s in sets]
            own = pa.array([xxhash.xxh3_128_digest(r) == fp.as_py() for r, fp in zip(raw, batch.column(2), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(own), pa.array(raw, pa.binary()).filter(own)], ["node", "shingles"])

    return texts.select("node", "text", "fp").mapInArrow(run, "node long, shingles binary")


def _labelled(rows: DataFrame, classes: DataFrame, label: DataFrame, id_col: str) -> DataFrame:
    named = classes.select("fp", "node").join(label, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    out = rows.filter("fp IS NOT NULL").select("id", "n_shingles", "fp").join(named, "fp").drop("fp")
    without_id = F.col("component") >= NO_ID
    out = out.withColumn("component", F.when(~without_id, F.col("component")))
    none = rows.filter("fp IS NULL").select("id", "n_shingles", F.col("id").alias("component"))
    both = out.select("id", "n_shingles", "component").unionByName(none)
    kept = F.coalesce(F.col("id") == F.col("component"), F.col("component").isNull())
    return both.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def keep_one(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of df, of one document of each component: the one of least id. Of repeated ids the least row stays; rows without id can't be named and stay."""
    kept = near_duplicates(df, size, percent, id_col, text_col).filter(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()
    # own names inside, so that no column's name can clash; maps have no order, so rows with some go by their other columns
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    ordered = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), whole.alias("__row"), *([F.struct(*ordered).alias("__by")] if len(ordered) < len(df.columns) else []))
    least = F.min_by("__row", "__by") if "__by" in rows.columns else F.min("__row")
    named = rows.join(kept, "__id").groupBy("__id").agg(least.alias("__row")).select("__row")
    both = named.unionByName(rows.filter("__id IS NULL").select("__row"))
    return both.select(*[F.col("__row").getField(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
