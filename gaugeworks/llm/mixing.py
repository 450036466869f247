"""Mixing sources to target weights: fixed-length blocks, shards of slots, permuted block indexes.

1. `sizes`: one scan counts the words of every text.
2. `shares`: sources in order of code points, null last, have repeating weights and share the words of all. A
   target stops at `cap` times its source; the excess is shared again by weight until no target is above.
   Whole numbers up to the last division.
3. `extents`: the texts of a source, in a fixed order, are one stream of words, cut into blocks of
   `block_words`. Where a text starts in its stream is a sum over buckets and within a bucket, so no task
   holds a source.
4. `slots`: a source has as many slots as blocks meet its target. All slots are dealt to output shards of
   equal size by a keyed permutation of all places: a shard's counts by source are a multinomial draw, given
   the totals of the sources (`shard_counts`). A free draw would miss the targets of small sources by a
   tenth and could ask for more blocks than `cap` allows.
5. A source's slots go through its blocks, epoch by epoch, each in an order of its own: slot j reads the block
   that the epoch's permutation gives for j. `pieces` joins slots and texts by source and block.

Permutations are rounds of multiplying and swap-or-not over [0, n): bijective for every n, without sorting or
walking. All of it are DataFrame functions. Reruns agree, whatever the partitions.

Null text counts as the empty text. Texts without words have their row with taken 0; a source without words has
target 0. Null sources are one source, told apart from ''. A null doc_id is an id like others. Very long texts
span many blocks. Ties: rows of one id are ordered by the hash of their text; repeated rows have a
place each. An empty table gives an empty result. Only id, text and source are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import NOT_GAP, text_or_empty, written

ROUNDS = 6
#: Primes to stretch by; no n in range is a multiple of all three.
PRIMES = (100_003, 100_019, 100_043)
#: Rows of a bucket at most, on average, and the least number of buckets.
BUCKET_ROWS, BUCKETS = 50_000, 256
#: Slots that one row of the source table is cut into at a time.
CHUNK = 65_536


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    cap: int = 3
    block_words: int = 32
    shard_slots: int = 4096
    seed: int = 11


def permuted(rows: DataFrame, to: str, x: Column, n: Column, key: Column, rounds: int = ROUNDS) -> DataFrame:
    """Adds column `to`: the place of x under a permutation of [0, n), n < 9e13, that belongs to the key.

    A round stretches by a prime that n is no multiple of, then ties every place to one other and swaps both or
    neither. Each half round is a projection, so that they are compiled; as one lambda they took 30 times as long.
    """
    prime = F.when(n % PRIMES[0] != 0, PRIMES[0]).when(n % PRIMES[1] != 0, PRIMES[1]).otherwise(PRIMES[2]).cast("long")
    out = rows.select("*", x.cast("long").alias(to), prime.alias("__prime"), n.cast("long").alias("__n"), key.alias("__key"))
    for r in range(rounds):
        at = F.col(to)
        out = out.withColumn(to, F.expr(f"pmod(`{to}` * __prime + pmod(xxhash64(__key, {2 * r}), __n), __n)"))
        other = F.expr(f"pmod(pmod(xxhash64(__key, {2 * r + 1}), __n) - `{to}`, __n)")
        out = out.withColumn("__other", other)
        out = out.withColumn(to, F.when(F.xxhash64(F.lit(r), "__key", F.greatest(at, F.col("__other"))).bitwiseAND(F.lit(1)) == 1, F.col("__other")).otherwise(at)).drop("__other")
    # explode of one: a filter or join key on the place would be pushed through all rounds, and written out three times in each
    return out.drop("__prime", "__n", "__key").withColumn(to, F.explode(F.array(to)))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, own, size): each text's words, and its hash to tell rows of one id apart; written, as several steps read it."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text_or_empty(text_col).alias("text"))
    return written(texts.select("doc_id", "source", F.xxhash64("text").alias("own"), F.regexp_count("text", F.lit(NOT_GAP + "+")).cast("long").alias("size")), "mix-sizes")


def in_order(rows: DataFrame, order: list[Column], values: list[str], label: str) -> DataFrame:
    """Rows with `place` and, for each value, the sum of it over all rows before (`value_before`), over a total order that range partitions carry."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), label)
    sums = {"place": F.lit(1).cast("long"), **{f"{v}_before": F.col(v) for v in values}}
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    totals = dealt.groupBy("part").agg(*[F.sum(c).alias(f"all_{k}") for k, c in sums.items()])
    starts = totals.select("part", *[F.coalesce(F.sum(f"all_{k}").over(before), F.lit(0)).alias(f"from_{k}") for k in sums])
    own = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(k) for k, c in sums.items()])
    return own.join(F.broadcast(starts), "part").select(*rows.columns, *[(F.col(k) + F.col(f"from_{k}")).alias(k) for k in sums])


def shares(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008  frozen
    """(source, rank, source_size, target, blocks, slots, slots_before) for every source that occurs; written."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = in_order(totals, [F.col("source").asc_nulls_last()], [], "mix-ranks")
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("place") % len(mix.weights) + 1).cast("int"))
    ranked = written(ranked.select("source", F.col("place").alias("rank"), "source_size", weight.cast("long").alias("weight")), "mix-weights")
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    most = mix.cap * F.col("source_size")
    words, weights = (int(x or 0) for x in ranked.agg(F.sum("source_size"), F.sum("weight")).first())
    capped = capped_weight = 0
    while True:  # the level rises, so a capped source stays so; rounds end when no other one joins
        left, open_weight = words - capped, weights - capped_weight
        at_cap = mix.cap * whole("source_size") * F.lit(open_weight).cast("decimal(18,0)") <= F.lit(left).cast("decimal(18,0)") * whole("weight")
        now = tuple(int(x or 0) for x in ranked.filter(at_cap).agg(F.sum(most), F.sum("weight")).first())
        if now == (capped, capped_weight):
            break
        capped, capped_weight = now
    even = F.lit(left).cast("double") * F.col("weight") / F.lit(max(open_weight, 1)).cast("double")
    blocks = F.ceil(F.col("source_size") / mix.block_words).cast("long")
    ranked = ranked.select("source", "rank", "source_size", F.when(at_cap, most.cast("double")).otherwise(even).alias("target"), blocks.alias("blocks"))
    slots = F.when(F.col("source_size") == 0, 0).otherwise(F.least(mix.cap * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long")))
    return written(in_order(ranked.withColumn("slots", slots), [F.col("rank")], ["slots"], "mix-slots").drop("place"), "mix-shares")


def extents(sized: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, own, size, rank, source_size, target, start): where each text starts in its source's stream of words.

    Buckets hold some ten thousand rows of a source, and a source has one row a bucket, so a hot source is spread.
    """
    buckets = max(BUCKETS, -(-sized.count() // BUCKET_ROWS))
    row = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "own", "size"), F.lit(buckets)))
    ahead = lambda *by: F.coalesce(F.sum("size").over(Window.partitionBy("source", *by[0]).orderBy(*by[1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = row.groupBy("source", "bucket").agg(F.sum("size").alias("size")).select("source", "bucket", ahead([], ["bucket"]).alias("bucket_start"))
    known = starts.join(shared, starts.source.eqNullSafe(shared.source)).select(starts.source, "bucket", "bucket_start", "rank", "source_size", "target")
    own = row.select("*", ahead(["bucket"], ["doc_id", "own", "size"]).alias("inside"))
    same = own.source.eqNullSafe(known.source) & (own.bucket == known.bucket)
    return own.join(known, same).select("doc_id", "own", "size", "rank", "source_size", "target", (F.col("bucket_start") + F.col("inside")).alias("start"))


def slots(shared: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008  frozen
    """(rank, slot, epoch, block, unit, units) for every slot of the mix; unit: its number among all."""
    total = int(shared.agg(F.sum("slots")).first()[0] or 0)
    chunks = shared.filter("slots > 0").select("rank", "blocks", "slots", "slots_before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long"))).alias("chunk"))
    # by number: a chunk is one short row here, which would be coalesced with all others, and its slots are the work
    tasks = max(int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * CHUNK)))
    dealt = chunks.repartition(tasks, F.col("rank"), F.col("chunk"))
    slot = F.explode(F.sequence("chunk", F.least(F.col("chunk") + CHUNK, F.col("slots")) - 1))
    each = dealt.select("rank", "blocks", "slots_before", slot.alias("slot"))
    each = each.withColumn("epoch", F.expr("CAST(slot div blocks AS INT)"))
    order = each.withColumn("order", F.xxhash64(F.lit(mix.seed), F.lit("blocks"), "rank", "epoch"))
    return permuted(order, "block", F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("order")).select("rank", "slot", "epoch", "block", (F.col("slots_before") + F.col("slot")).alias("unit"), F.lit(max(total, 1)).cast("long").alias("units"))


def dealt_out(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008  frozen
    """Rows of slots with shard and place in it: a permutation of all units deals every shard `shard_slots` of them."""
    spot = permuted(rows, "spot", F.col("unit"), F.col("units"), F.xxhash64(F.lit(mix.seed), F.lit("shards")))
    shard, place = F.expr(f"spot div {mix.shard_slots}"), (F.col("spot") % mix.shard_slots).cast("int")
    return spot.withColumns({"shard": shard, "place": place}).drop("spot", "unit", "units")


def shard_counts(slotted: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008  frozen
    """(shard, rank, n): how many blocks of each source a shard drew."""
    return dealt_out(slotted, mix).groupBy("shard", "rank").agg(F.count("*").alias("n"))


def pieces(spans: DataFrame, slotted: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008  frozen
    """Slots joined with the texts whose words their blocks hold: shard, place, epoch, block, the text's id, own, rank and start, its first word in the block (from 0) and words."""
    size = F.lit(mix.block_words).cast("long")
    blocks = F.explode(F.expr(f"sequence(start div {mix.block_words}, (start + size - 1) div {mix.block_words})"))
    held = spans.filter("size > 0").select("doc_id", "own", "size", "rank", "start", blocks.alias("block"))
    low = F.greatest(F.col("block") * size, F.col("start"))
    high = F.least((F.col("block") + 1) * size, F.col("start") + F.col("size"))
    parts = held.select("doc_id", "own", "rank", "start", "block", (low - F.col("start")).alias("first_word"), (high - low).alias("words"))
    return dealt_out(slotted.join(parts, ["rank", "block"]), mix).select("shard", "place", "epoch", "rank", "block", "doc_id", "own", "start", "first_word", "words")


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:  # noqa: B008  frozen
    """The mix itself: (shard, place, source, epoch, block, text), a row for each slot, the words of its block joined by blanks."""
    sized = sizes(docs, id_col, text_col, source_col)
    shared = shares(sized, mix)
    parts = pieces(extents(sized, shared), written(slots(shared, mix), "mix-drawn"), mix)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("own", F.xxhash64("text")).dropDuplicates(["doc_id", "own"])
    words = F.regexp_extract_all("text", F.lit(f"({NOT_GAP}+)"), F.lit(1))
    texts = texts.select(F.col("doc_id").alias("text_id"), F.col("own").alias("text_own"), words.alias("text_words"))
    same = parts.doc_id.eqNullSafe(texts.text_id) & (parts.own == texts.text_own)
    own = F.array_join(F.slice("text_words", (F.col("first_word") + 1).cast("int"), F.col("words").cast("int")), " ")
    held = parts.join(texts, same).select("shard", "place", "rank", "epoch", "block", "start", own.alias("text"))
    rows = held.groupBy("shard", "place", "rank", "epoch", "block").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
    named = rows.join(shared.select("rank", "source"), "rank")
    return named.select("shard", "place", "source", "epoch", "block", F.array_join(F.transform("parts", lambda p: p.text), " ").alias("text"))


def taken(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:  # noqa: B008  frozen
    """(doc_id, size, source_size, target, taken, first_shard) for every row: the words that the mix takes of it and the first shard that has some."""
    sized = sizes(docs, id_col, text_col, source_col)
    shared = shares(sized, mix)
    spans = written(extents(sized, shared), "mix-extents")
    counted = pieces(spans, written(slots(shared, mix), "mix-drawn"), mix).groupBy("rank", "start").agg(F.sum("words").alias("taken"), F.min("shard").alias("first_shard"))
    rows = spans.filter("size > 0").join(counted, ["rank", "start"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_shard")
    none = spans.filter("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_shard"))
    return rows.unionByName(none).withColumnRenamed("doc_id", id_col)
