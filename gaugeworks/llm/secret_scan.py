"""Secret scans with corpus-wide ownership frequency.

Three base kinds are found in every text: assignments (`password = ...`), access keys (`AKIA...`) and long
hexadecimal runs. The method adds candidates of further kinds (tokens with a known prefix, signed web
tokens, private key blocks, random-looking strings), hashes the value of every candidate, and counts over the
whole corpus the distinct repositories and owners that hold each value. A value that many owners share, or that
is in many repositories of several owners, is a copied example (many: a share of the owners and repositories that
the corpus has, a few at least); one that keeps to its owner looks live, in
however many of the owner's repositories it is. Base spans are always returned; an added span is returned if it
looks live and lies beside all base spans.

The owner of a document is its source, a repository the document itself, unless other columns are named.
Values are counted by (value, owner, repository) before they meet; the few values that make a thousandth of all
candidates or more, at most a thousand, are joined by broadcast, so no value makes a large task.

Null text: as the empty text, no spans. Null owners and repositories count as one owner and one
repository. Very long texts are scanned whole; the work grows with their length, also where they hold tens of
thousands of spans. Ties: spans with one start are in the order of the kinds. Repeated rows: each is scanned
and returned; they are one repository. Empty tables: empty result. The values themselves never leave the scan,
only their hashes. Other columns of the input are not read, or kept as they are (`redact`), whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encoder import forget
from .shared import by_frequency, small_batches, written

#: Base kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORD = re.compile(r"(?ai)passw|secret|token|api_?key")
#: Added kinds. The last takes any run of the alphabet with a digit and a capital and is held to its entropy.
ADDED = {
    "prefixed": re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|glpat-[A-Za-z0-9_-]{18,})"),
    "signed": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "private": re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{40,}?-----END [A-Z ]{0,20}PRIVATE KEY-----"),
    "random": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}+(?!=)"),
}
_HINTS = {"prefixed": re.compile(r"gh[pousr]_|xox[abpr]-|sk_live_|AIza|glpat-"), "signed": re.compile("eyJ"), "private": re.compile("PRIVATE KEY"), "random": re.compile(r"[A-Za-z0-9+/_-]{32}")}
_DIGIT, _CAPITAL = re.compile("[0-9]"), re.compile("[A-Z]")
#: Added values below so many bits a character are words, not keys.
BITS = 4.0
#: A value held by so many owners, or by two owners or more in so many repositories, is a copied example: these
#: numbers, or these shares of the corpus's owners and repositories, whichever is more.
OWNERS, REPOS = 3, 20
OWNER_SHARE, REPO_SHARE = 0.001, 0.0001


def bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the base kinds, by start, then kind."""
    out = []
    if _KEYWORD.search(text):
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int, str]]:
    """The added kinds' candidates that lie beside the taken spans and one another."""
    out: list[tuple[int, int, int, str]] = []
    starts: list[int] = []  # of what is taken, without overlaps and in order
    ends: list[int] = []
    for a, b in sorted(taken):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for k, (kind, pattern) in enumerate(ADDED.items(), len(KINDS)):
        if not _HINTS[kind].search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "random" and not (_DIGIT.search(m[0]) and _CAPITAL.search(m[0]) and bits(m[0]) >= BITS):
                continue
            at = bisect.bisect_left(ends, m.start() + 1)
            if at == len(starts) or starts[at] >= m.end():
                out.append((m.start(), k, m.end(), m[0]))
                starts.insert(at, m.start())
                ends.insert(at, m.end())
    return sorted(out)


_SPANS = "array<struct<kind:int,start:int,end:int,hash:binary>>"


_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())]))


def candidates(df: DataFrame, text_col: str, owner: Column, repo: Column, keep: Column) -> DataFrame:
    """(row, keep, owner, repo, spans, base_sha256): every row with its candidates; row numbers the rows, so write it before use."""
    names = [*KINDS, *ADDED]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches, 0):
            spans, digest = [], []
            for text in batch.column(0).to_pylist():
                base = base_spans(text) if text else []
                more = added_spans(text, [(a, b) for a, _, b, _ in base]) if text else []
                digest.append(hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b, _ in base).encode()).hexdigest())
                spans.append([{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()} for a, k, b, v in base + more])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(spans, _SPAN), pa.array(digest, pa.string())], ["keep", "owner", "repo", "spans", "base_sha256"])

    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("text"), keep.alias("keep"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.coalesce(repo.cast("string"), F.lit("")).alias("repo"))
    kind = rows.schema["keep"].dataType.simpleString()
    return rows.mapInArrow(scan, f"keep {kind}, owner string, repo string, spans {_SPANS}, base_sha256 string").withColumn("row", F.monotonically_increasing_id())


def ownership(found: DataFrame, owners: int = OWNERS, repos: int = REPOS) -> DataFrame:
    """(hash, n, n_owners, n_repos, live) of every candidate value, over the whole corpus; n: its candidates."""
    each = found.select("owner", "repo", F.explode("spans.hash").alias("hash"))
    # by value, owner and repository first: a value on a third of all rows is counted by many tasks
    counted = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = counted.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    total = by_owner.groupBy("hash").agg(F.sum("n").alias("n"), F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
    example = (F.col("n_owners") >= owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= repos))
    return total.withColumn("live", ~example)


def wanted(rows: DataFrame, owners: int = OWNERS, repos: int = REPOS) -> tuple[int, int]:
    """How many owners, and repositories, make a value an example in this corpus."""
    each = rows.groupBy("owner", "repo").agg(F.lit(1).alias("one")).groupBy("owner").agg(F.count("*").alias("repos"))
    n_owners, n_repos = each.agg(F.count("*"), F.sum("repos")).first()
    return max(owners, math.ceil(OWNER_SHARE * n_owners)), max(repos, math.ceil(REPO_SHARE * (n_repos or 0)))


def judged(rows: DataFrame, owners: int, repos: int) -> DataFrame:
    """(row, kind, start, end, live, n_owners, n_repos): every candidate of written rows with the verdict on its value."""
    counted = written(ownership(rows, *wanted(rows, owners, repos)), "secret-owners")
    each = rows.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.kind", "s.start", "s.end", "s.hash")
    return by_frequency(each, counted, "hash").drop("hash", "n")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repo: Column | None = None, owners: int = OWNERS, repos: int = REPOS) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, found) for every row.

    found: structs (kind, start, end, live, n_owners, n_repos) of the spans returned, by start. An example is a value
    that `owners` or more owners hold, or two or more in `repos` or more repositories, or more as the corpus has more (`wanted`).
    """
    owner = F.col("source") if owner is None else owner
    repo = F.col(id_col) if repo is None else repo
    rows = written(candidates(df, text_col, owner, repo, F.col(id_col).cast("long")), "secret-candidates")
    found = judged(rows, owners, repos).filter((F.col("kind") < len(KINDS)) | F.col("live"))
    by_row = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "n_owners", "n_repos"))).alias("s"))
    names = F.array(*[F.lit(k) for k in (*KINDS, *ADDED)])
    named = F.transform("s", lambda x: F.struct(F.get(names, x.kind).alias("kind"), x.start.alias("start"), x["end"].alias("end"), x.live.alias("live"), x.n_owners.alias("n_owners"), x.n_repos.alias("n_repos")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,live:boolean,n_owners:bigint,n_repos:bigint>>")
    out = rows.select("row", F.col("keep").alias("id"), "base_sha256").join(by_row.select("row", named.alias("found")), "row", "left").withColumn("found", F.coalesce("found", none))

    def count(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("found", lambda x: test(x))).cast("long")

    def of(kind: str) -> Column:
        return count(lambda x: x.kind == kind).alias(f"n_{kind}")

    return out.select(
        F.col("id").alias(id_col),
        *map(of, KINDS),
        "base_sha256",
        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x["end"].cast("string"))), ",").alias("spans"),
        count(lambda x: x.live).alias("n_live"),
        count(lambda x: ~x.live).alias("n_example"),
        "found",
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repo: Column | None = None, owners: int = OWNERS, repos: int = REPOS, mark: str = "<secret>") -> DataFrame:
    """All rows and columns of df, each stretch of live spans in its text replaced by a mark; examples stay. One scan: rows are written with their candidates."""
    owner = F.col("source") if owner is None else owner
    repo = F.col(f"`{id_col}`") if repo is None else repo
    at = df.columns.index(text_col)
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = written(candidates(df, text_col, owner, repo, whole), "secret-candidates")
    cuts = judged(rows, owners, repos).filter("live").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    # texts with candidates are few; only they are shuffled
    some = rows.filter(F.size("spans") > 0).select("row", "keep").join(cuts, "row", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches, at):
            out = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                parts, done = [], 0
                for span in spans or ():
                    if span["start"] >= done:
                        parts += [text[done : span["start"]], mark]
                    done = max(done, span["end"])
                out.append(text if not parts else "".join([*parts, text[done:]]))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    own = [F.col(f"keep.c{i}").alias(f"c{i}") for i in range(len(df.columns))]
    flat = some.select(*own, "cuts").withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    done = flat.mapInArrow(cut, ", ".join(f"c{i} {'string' if i == at else f.dataType.simpleString()}" for i, f in enumerate(df.schema)))
    plain = rows.filter(F.size("spans") == 0).select(*own)
    both = done.unionByName(plain)
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
