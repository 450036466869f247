"""Token ids in binary shards, with a minimal perfect hash index from document keys to shard places.

A store is a folder:

  shard-00007-00002.bin  8 bytes magic, then little-endian: u32 bytes per id (2 or 4), u64 documents,
                         u64 ids, the documents' lengths in ids (u32 each), and their raw ids one after the other
  index-00003.bin        one bucket of the index: u32 levels, u64 keys, per level u64 bits and the packed bit
                         array, then one entry a key: u64 fingerprint, u64 shard, u64 documents with the key,
                         u64 first document in the shard, u64 first id in the shard
  shards, parts          small Parquet tables: the shards in order with the documents and ids before each, and
                         the places of those keys whose documents lie in several shards

The index takes a key's bucket from its hash; inside a bucket each level maps the keys that are left to
bits, keeps those alone on their bit and passes the rest on, so a key's place is the number of bits set
before its own (its rank): as many places as keys, found in a constant number of steps. The stored
fingerprint, another hash of the key, tells foreign keys.

Documents are in ascending order of key, then of their text's hash, so the order is the same each time and a
key that a third of all rows have is many ranges. A task writes a shard whenever it holds SHARD_IDS ids, so
its memory does not grow with the corpus; a longer document is a shard of its own. Rows that share a
key and a shard are one entry, with their number; a key in several shards has an entry of 0 documents, and
its places are in `parts`, as are those of the null key, which the index doesn't hold. Null text is the empty
text (the end id alone). Very long texts are encoded whole. Empty tables make a store without shards, and
readings from it are empty. Other columns of the input are not read.

Files are written by the tasks under a name of their own and then renamed, so a task that runs again
replaces its file with the same bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encoder import chunk_encoder
from .shared import small_batches, written
from .words import mix

MAGIC = b"TOKSHRD1"
_PLACE = ("shard", "documents", "document", "start")
_ENTRY = np.dtype([("fingerprint", "<u8"), *((name, "<u8") for name in _PLACE)])
#: Ids in a shard: 32 MB while they are held.
SHARD_IDS = 8_000_000
#: Bytes of text for a task; files of a task; ids between two documents that are rather read than skipped; ids read at once.
TASK_BYTES, TASK_FILES, SKIP, RUN = 128_000_000, 1 << 20, 16_384, 4_000_000


# ---------------------------------------------------------------- the perfect hash, in numpy


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_hash(keys, 1001) % np.uint64(buckets)).astype(np.int64)


def fingerprint_of(keys: np.ndarray) -> np.ndarray:
    return _hash(keys, 2002)


class PerfectHash:
    """A minimal perfect hash over distinct keys: levels of bit arrays, places by rank."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.concatenate(([0], np.cumsum(bits, dtype=np.int64))) for bits in levels]
        self.base = np.concatenate(([0], np.cumsum([b[-1] for b in self.before]))).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        left, levels = keys, []
        while len(left):
            bits = max(8, int(room * len(left)))
            slot = (_hash(left, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(slot, minlength=bits) == 1
            levels.append(alone)
            left = left[~alone[slot]]
            if len(levels) > 200:
                raise ValueError("keys of a perfect hash must be distinct")
        return cls(levels)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """0 to n-1 for the keys it was built of; -1 or any place for others."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            slot = (_hash(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[slot]
            out[left[here]] = self.base[level] + self.before[level][slot[here]]
            left = left[~here]
        return out


# ---------------------------------------------------------------- files


def _put(path: str, parts: list[bytes]) -> None:
    fs, at = pafs.FileSystem.from_uri(path)
    own = f"{at}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as file:
        for part in parts:
            file.write(part)
    fs.move(own, at)


def write_shard(path: str, ids: list[bytes]) -> None:
    """ids: each document's as little-endian u32."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if flat.max(initial=0) < 65536 else 4
    head = MAGIC + struct.pack("<IQQ", width, len(ids), len(flat)) + np.array([len(x) // 4 for x in ids], "<u4").tobytes()
    _put(path, [head, flat.astype(f"<u{width}").tobytes()])


class Shard:
    """A shard opened for reading by place."""

    def __init__(self, path: str):
        fs, at = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(at)
        head = self.file.read_at(28, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token shard")
        self.width, self.documents, self.total = struct.unpack("<IQQ", head[8:])
        self.at = 28 + 4 * self.documents

    def lengths(self) -> np.ndarray:
        """Each document's number of ids."""
        return np.frombuffer(self.file.read_at(4 * self.documents, 28), "<u4").astype(np.int64)

    def ids(self, start: int, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * self.width, self.at + start * self.width), f"<u{self.width}")


def write_index(path: str, keys: np.ndarray, entries: np.ndarray) -> None:
    hashed = PerfectHash.build(keys)
    table = np.zeros(len(keys), _ENTRY)
    table[hashed.place(keys)] = entries
    parts = [struct.pack("<IQ", len(hashed.levels), len(keys))]
    for bits in hashed.levels:
        parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
    _put(path, [*parts, table.tobytes()])


class IndexBucket:
    def __init__(self, path: str):
        fs, at = pafs.FileSystem.from_uri(path)
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            self.hashed, self.table = PerfectHash([]), np.zeros(0, _ENTRY)
            return
        with fs.open_input_file(at) as file:
            raw = file.read()
        levels, n = struct.unpack_from("<IQ", raw, 0)
        p, arrays = 12, []
        for _ in range(levels):
            (bits,) = struct.unpack_from("<Q", raw, p)
            size = (bits + 7) // 8
            arrays.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, p + 8), count=bits).astype(bool))
            p += 8 + size
        self.hashed, self.table = PerfectHash(arrays), np.frombuffer(raw, _ENTRY, n, p)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, entries): entries of the keys that are there."""
        place = self.hashed.place(keys)
        found = place >= 0
        found[found] = self.table["fingerprint"][place[found]] == fingerprint_of(keys[found])
        return found, self.table[place[found]]


# ---------------------------------------------------------------- Spark jobs


@dataclass(frozen=True)
class Store:
    folder: str
    buckets: int


def _shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard // TASK_FILES:05d}-{shard % TASK_FILES:05d}.bin"


def write_store(df: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", keys_per_bucket: int = 1_000_000, shard_ids: int = SHARD_IDS) -> Store:
    """Encode every text, end it with end_id and write the store. Keys are whole numbers."""
    spark = df.sparkSession
    fs, at = pafs.FileSystem.from_uri(folder)
    fs.create_dir(at, recursive=True)
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = chunk_encoder(tokenizer), TaskContext.get().partitionId() * TASK_FILES
        keys: list[int | None] = []
        held: list[bytes] = []
        size = file = 0

        def entries() -> pa.RecordBatch:
            write_shard(_shard_path(folder, task + file), held)
            n = np.fromiter((len(x) // 4 for x in held), np.int64, len(held))
            before = np.cumsum(n) - n
            first = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
            edges = np.append(first, len(keys))
            columns = [np.full(len(first), task + file), np.diff(edges), edges[:-1], before[first], np.add.reduceat(n, first)]
            return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in first], pa.int64()), *(pa.array(c.astype(np.int64)) for c in columns)], ["key", *_PLACE, "ids"])

        for batch in small_batches(batches):
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                if held and size + len(ids) // 4 + 1 > shard_ids:
                    yield entries()
                    keys, held, size, file = [], [], 0, file + 1
                keys.append(key)
                held.append(ids + end)
                size += len(ids) // 4 + 1
        if held:
            yield entries()

    rows = df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).withColumn("own", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    ordered = rows.repartitionByRange(tasks, "key", "own").sortWithinPartitions("key", "own").drop("own")
    entries = written(ordered.mapInArrow(encode, "key long, shard long, documents long, document long, start long, ids long"), "token-entries")
    # a row of some numbers for each shard, of 32 MB of ids
    in_order = Window.orderBy("shard")
    ends = entries.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count_if(F.col("key").isNull()).alias("nameless"), F.sum("documents").alias("documents"), F.sum("ids").alias("ids"))
    before = lambda c: F.coalesce(F.sum(c).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{c}_before")
    ends = written(ends.select("*", before("documents"), before("ids"), F.lag("high").over(in_order).alias("last_high")), "token-shards")
    ends.select("shard", "documents", "ids", "documents_before", "ids_before").write.parquet(f"{folder}/shards")
    several = ends.filter("low = last_high").select(F.col("low").alias("key")).distinct()
    parts = entries.join(several, "key", "left_semi").unionByName(entries.filter("key IS NULL"))
    parts.select("key", *_PLACE).write.parquet(f"{folder}/parts")
    alone = entries.filter("key IS NOT NULL").join(several, "key", "left_anti").select("key", *_PLACE)
    zero = F.lit(0).cast("long")
    indexed = alone.unionByName(several.select("key", *[zero.alias(n) for n in _PLACE]))
    buckets = max(1, -(-entries.count() // keys_per_bucket))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            where = bucket_of(batch.column(0).to_numpy(), buckets)
            for b in np.unique(where):
                own.setdefault(int(b), []).append(batch.filter(pa.array(where == b)))
        for b, tables in own.items():
            table = pa.Table.from_batches(tables)
            key = table["key"].to_numpy()
            entry = np.zeros(len(key), _ENTRY)
            entry["fingerprint"] = fingerprint_of(key)
            for name in _PLACE:
                entry[name] = table[name].to_numpy()
            write_index(f"{folder}/index-{b:05d}.bin", key, entry)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([len(key)], pa.int64())], ["bucket", "keys"])

    _by_bucket(indexed, buckets).mapInArrow(index, "bucket long, keys long").write.format("noop").mode("overwrite").save()
    return Store(folder, buckets)


def _by_bucket(keyed: DataFrame, buckets: int) -> DataFrame:
    """All rows of a bucket in one task: about a million small entries each, as there are that many buckets."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket_of(batch.column(0).to_numpy(), buckets))], [*batch.schema.names, "bucket"])

    kinds = ", ".join(f"{n} {t}" for n, t in keyed.dtypes)
    return keyed.mapInArrow(number, f"{kinds}, bucket long").repartition(buckets, "bucket").drop("bucket")


def locate(keys: DataFrame, store: Store, id_col: str = "doc_id") -> DataFrame:
    """(key, shard, documents, document, start) of those of the given keys that the store has, by its index; a key in several shards has several rows."""
    folder, buckets = store.folder, store.buckets

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, IndexBucket] = {}
        for batch in batches:
            key = batch.column(0).to_numpy()
            where = bucket_of(key, buckets)
            for b in np.unique(where):
                if b not in opened:
                    opened = {int(b): IndexBucket(f"{folder}/index-{b:05d}.bin")}
                own = key[where == b]
                found, entry = opened[int(b)].find(own)
                yield pa.RecordBatch.from_arrays([pa.array(own[found]), *(pa.array(entry[n].astype(np.int64)) for n in _PLACE)], ["key", *_PLACE])

    rows = keys.select(F.col(id_col).cast("long").alias("key")).distinct()
    found = _by_bucket(rows.filter("key IS NOT NULL"), buckets).mapInArrow(look, "key long, shard long, documents long, document long, start long")
    parts = keys.sparkSession.read.schema("key long, shard long, documents long, document long, start long").parquet(f"{folder}/parts")
    if parts.isEmpty():
        return found
    found = written(found, "token-places")
    several = parts.join(found.filter("documents = 0").select("key"), "key", "left_semi")
    found = found.filter("documents > 0").unionByName(several)
    return found if rows.filter("key IS NULL").isEmpty() else found.unionByName(parts.filter("key IS NULL"))


def read_ids(places: DataFrame, store: Store) -> DataFrame:
    """(key, document, start in the shard, ids array<long>, shard) for each document at the given places."""
    return _read(places, store, "ids array<long>", lambda ids: (pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())),))


def read_digests(places: DataFrame, store: Store) -> DataFrame:
    """As read_ids, with n_tokens and ids_crc32 (of the ids as little-endian u32) for the ids."""

    def digest(ids: list[np.ndarray]) -> tuple[pa.Array, ...]:
        return pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())

    return _read(places, store, "n_tokens long, ids_crc32 long", digest)


def runs(start: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Documents (from, to), in order of their place, that are read together: close to one another, and about RUN ids at most."""
    a = 0
    for i in range(1, len(start) + 1):
        if i == len(start) or start[i] - start[i - 1] - n[i - 1] > SKIP or start[i] + n[i] - start[a] > RUN:
            yield a, i
            a = i


def _read(places: DataFrame, store: Store, kinds: str, made) -> DataFrame:  # noqa: ANN001
    folder = store.folder
    names = ["key", "shard", "document", "start", *(x.split(" ")[0] for x in kinds.split(", "))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, lengths = (-1, None), np.zeros(0, np.int64)
        for batch in batches:
            shards = batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1]))) if len(shards) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(shards)) if len(shards) else [], strict=True):
                part = batch.slice(a, b - a)
                shard = int(shards[a])
                if shard != opened[0]:
                    opened = shard, Shard(_shard_path(folder, shard))
                    lengths = opened[1].lengths()
                documents, first, at = (part.column(i).to_numpy() for i in (2, 3, 4))
                # an entry of several documents is one row for each
                entry = np.repeat(np.arange(len(documents)), documents)
                document = first[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(documents) - documents, documents)
                n = lengths[document]
                ahead = np.cumsum(n) - n
                start = at[entry] + ahead - ahead[np.repeat(np.cumsum(documents) - documents, documents)]
                key = part.column(0)
                for i, j in runs(start, n):
                    flat = opened[1].ids(int(start[i]), int(start[j - 1] + n[j - 1] - start[i]))
                    ids = [flat[x : x + m] for x, m in zip(start[i:j] - start[i], n[i:j], strict=True)]
                    own = pa.array(entry[i:j])
                    yield pa.RecordBatch.from_arrays([key.take(own), pa.array(np.full(j - i, shard)), pa.array(document[i:j]), pa.array(start[i:j]), *made(ids)], names)

    ordered = places.select("key", *_PLACE).repartition("shard").sortWithinPartitions("shard", "document")
    return ordered.mapInArrow(read, f"key long, shard long, document long, start long, {kinds}")


def digests(df: DataFrame, store: Store, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of df, looked up through the index and read back from the shards."""
    read = read_digests(locate(df, store, id_col), store)
    starts = df.sparkSession.read.schema("shard long, ids_before long").parquet(f"{store.folder}/shards")
    return read.join(starts, "shard").select(F.col("key").alias(id_col), (F.col("ids_before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
