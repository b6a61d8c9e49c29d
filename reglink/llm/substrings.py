"""Substring deduplication by compaction of a de Bruijn graph of words.

The edges of the graph are the windows of ``size`` consecutive words; an
edge that occurs more than once is repeated text. Most edges lie on long
nonbranching paths, so they are not shuffled one by one:

1. Paths. Every window has a seed: its smallest hashed ``SEED``-word k-mer.
   Equal windows have equal seeds, and consecutive windows with the same seed
   form a path (about a dozen edges), stored by its seed and the hash of all
   its words.
2. Compaction by joins. A seed that occurs once leads nowhere: its paths are
   unique. If all paths of a seed are equal, the path does not branch: all
   its edges are repeated, and it stays compact. Only at seeds whose paths
   differ, where the graph branches, are paths opened into single edges,
   which are counted by their own hash. Equal paths of such a seed are opened
   once, with their number.
3. Source coordinates. Repeated paths and edges go back to their places as
   word ranges. Spans are matched by two independent 64-bit hashes of the
   words at those coordinates, over the whole path or window.

Texts that are equal word for word are one source: with another copy all
their windows are repeated. Hashes, counts and ranges travel; a text moves
twice, compressed: once to open its branching paths, once to be cut.
Windows repeated within one text are found in place. Counts collapse before
each shuffle, and joins run on stored tables, so a passage in a third of all
texts is split over tasks.

Null and empty texts have no words. Equal rows each give their row; further
columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import PLAIN, Words, covered, find_words, mix, powers, slices, window_hashes

SIZE = 35
SEED = 10
_U = np.uint64


def _seeds(hashes: np.ndarray, size: int) -> np.ndarray:
    """The smallest k-mer hash of every window of ``size`` words."""
    least = window_hashes(hashes, SEED)
    width, span = size - SEED + 1, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least


def paths(hashes: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed, first window and number of windows of the paths of one text."""
    seeds = _seeds(hashes, size)
    first = np.flatnonzero(np.concatenate([[True], seeds[1:] != seeds[:-1]]))
    return seeds[first], first, np.diff(np.append(first, len(seeds)))


def _range_hash(hashes: np.ndarray, start: np.ndarray, length: np.ndarray, salt: int) -> np.ndarray:
    """Hash of each run of word hashes."""
    # Prefix sums of w[i] * c^i; c is odd, so dividing by c^start is a product.
    c = (0x2545F4914F6CDD1D + 2 * salt) & ((1 << 64) - 1)
    inverse = pow(c, -1, 1 << 64)
    prefix = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * powers(c, len(hashes)), dtype=_U)])
    total = (prefix[start + length] - prefix[start]) * powers(inverse, len(hashes) + 1)[start]
    return mix(total + length.astype(_U))


def _local(hashes: np.ndarray, size: int) -> np.ndarray:
    """Windows of one text that occur in it more than once."""
    w = window_hashes(hashes, size)
    ordered = np.sort(w)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(w, twice) if len(twice) else np.zeros(len(w), bool)


class Text:
    """Words and both hashes of one text of a slice."""

    def __init__(self, w: Words, both: tuple[np.ndarray, np.ndarray], i: int):
        a, b = int(w.first[i]), int(w.first[i + 1])
        self.n = b - a
        self.one, self.two = both[0][a:b], both[1][a:b]

    def path_rows(self, size: int):
        seed, first, n = paths(self.one, size)
        length = n + size - 1
        return seed, first, n, _range_hash(self.one, first, length, 0), _range_hash(self.two, first, length, 1)


def _digest(words: list[bytes]) -> bytes | None:
    """Equal for texts that are equal word for word; none without words."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _raw(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _texts(column: pa.Array) -> Iterator[Text]:
    w = find_words(column, PLAIN, False)
    both = (w.hashes(0), w.hashes(1))
    for i in range(len(column)):
        yield Text(w, both, i)


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            # bytes.split() parts at the six white-space bytes of the rule.
            words = [x.split() for x in _raw(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([_digest(w) for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int64())], names=["key", "source", "n_words"])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _paths(size: int, places: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                digest, rows = [], []
                for t, raw in zip(_texts(part.column("text")), _raw(part.column("text")), strict=True):
                    if t.n >= size:
                        rows.append(t.path_rows(size))
                        digest.append(_digest(raw.split()) if places else None)
                if not rows:
                    continue
                seed, first, n, one, two = (np.concatenate(x) for x in zip(*rows, strict=True))
                columns = {"seed": _signed(seed), "h1": _signed(one), "h2": _signed(two)}
                if places:
                    which = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
                    columns |= {"source": pa.array(digest, pa.binary()).take(pa.array(which)), "first": pa.array(first, pa.int32()), "n": pa.array(n, pa.int32())}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in slices(batch):
            raw = _raw(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([_digest(x.split()) for x in raw], pa.binary()), pa.array([press.compress(x) for x in raw], pa.binary())], names=["key", "source", "body"])


def _bodies(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x) for x in column.to_pylist()]


def _unpack(column: pa.Array) -> pa.Array:
    return pa.array(_bodies(column), pa.binary()).cast(pa.large_string())


def _windows(size: int):
    """Both hashes of every window of the branching paths of each source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                source, at, one, two = [], [], [], []
                for name, open_, t in zip(part.column("source").to_pylist(), part.column("open").to_pylist(), _texts(_unpack(part.column("body"))), strict=True):
                    start = np.concatenate([np.arange(x["first"], x["first"] + x["n"]) for x in open_])
                    length = np.full(len(start), size)
                    source += [name] * len(start)
                    at.append(start)
                    one.append(_range_hash(t.one, start, length, 2))
                    two.append(_range_hash(t.two, start, length, 3))
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array(source, pa.binary()), pa.array(np.concatenate(at), pa.int32()), _signed(np.concatenate(one)), _signed(np.concatenate(two))], names=["source", "at", "h1", "h2"])

    return run


def _cut(size: int):
    """Kept words of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                raws = _bodies(part.column("body"))
                w = find_words(pa.array(raws, pa.binary()).cast(pa.large_string()), PLAIN, False)
                hashes = w.hashes(0)
                lost, text, ranges = [], [], []
                for i, (raw, whole, spans) in enumerate(zip(raws, part.column("copied").to_pylist(), part.column("spans").to_pylist(), strict=True)):
                    words = raw.split()
                    one = hashes[int(w.first[i]):int(w.first[i + 1])]
                    gone = np.zeros(len(words), bool)
                    if len(words) >= size:
                        hit = np.ones(len(words) - size + 1, bool) if whole else _local(one, size)
                        for x in spans or ():
                            hit[x["first"]:x["first"] + x["n"]] = True
                        if hit.any():
                            gone = covered(len(words), np.flatnonzero(hit), size)
                    lost.append(int(gone.sum()))
                    text.append(b" ".join(compress(words, (~gone).tolist()) if lost[-1] else words).decode())
                    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                    ranges.append([{"first": int(p), "end": int(q)} for p, q in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(w.counts(), pa.int64()), pa.array(lost, pa.int64()), pa.array(text, pa.string()), pa.array(ranges, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))],
                    names=["key", "n_words", "n_removed", "kept_text", "removed"],
                )

    return run


def _null_safe(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def repeated_spans(source: DataFrame, copies: DataFrame, size: int = SIZE) -> DataFrame:
    """(source, spans) over distinct sources: ranges of windows that occur in
    another source too. ``copies`` has source, key and n (copies)."""
    kind = source.schema["key"].dataType.simpleString()
    # Counted over all rows; equal texts come up as often as they occur, which
    # is right for counting since their windows are repeated anyway.
    counted = source.select("text").mapInArrow(_paths(size, False), "seed bigint, h1 bigint, h2 bigint").groupBy("seed").agg(
        F.count("*").alias("rows"), F.min("h1").alias("lo1"), F.max("h1").alias("hi1"), F.min("h2").alias("lo2"), F.max("h2").alias("hi2")
    )
    seeds = frames.keep(counted.where("rows > 1").select("seed", ((F.col("lo1") != F.col("hi1")) | (F.col("lo2") != F.col("hi2"))).alias("branches")))
    placed = source.select("text").mapInArrow(_paths(size, True), "seed bigint, h1 bigint, h2 bigint, source binary, first int, n int")
    # A text's copies give equal rows; one of each is enough from here.
    found = frames.keep(placed.join(seeds.hint("merge"), "seed").select("source", "first", "n", "branches").distinct())
    whole = found.where(~F.col("branches")).select("source", "first", "n")
    open_ = found.where("branches").groupBy("source").agg(F.collect_list(F.struct("first", "n")).alias("open"))
    todo = frames.keep(open_.join(copies.select("source", "least"), "source").withColumnRenamed("source", "name"))
    bodies = source.mapInArrow(_pack, f"key {kind}, source binary, body binary")
    opened = bodies.join(todo.hint("merge"), (F.col("source") == F.col("name")) & _null_safe("key", "least")).select("source", "body", "open").dropDuplicates(["source"])
    # Every window with its places; one row for each place of each source.
    windows = frames.keep(opened.mapInArrow(_windows(size), "source binary, at int, h1 bigint, h2 bigint"))
    twice = frames.keep(windows.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"))
    single = windows.join(twice, ["h1", "h2"]).select("source", F.col("at").alias("first"), F.lit(1).alias("n"))
    return whole.union(single).groupBy("source").agg(F.collect_list(F.struct("first", "n")).alias("spans"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_text (the words
    that stay, joined by one space) and removed (word ranges)."""
    spark = docs.sparkSession
    frames.ready(spark)
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    members = source.mapInArrow(_sources, f"key {kind}, source binary, n_words bigint")
    copies = frames.keep(members.where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("c"), F.min("key").alias("least")))
    spans = repeated_spans(source, copies, size)
    marked = frames.keep(copies.join(spans, "source", "left").where("c > 1 OR spans IS NOT NULL").select(F.col("source").alias("name"), (F.col("c") > 1).alias("copied"), "spans"))
    bodies = source.mapInArrow(_pack, f"key {kind}, source binary, body binary")
    joined = bodies.join(marked.hint("merge"), F.col("source") == F.col("name"), "left").select("key", "body", F.coalesce("copied", F.lit(False)).alias("copied"), "spans")
    out = joined.mapInArrow(_cut(size), f"key {kind}, n_words bigint, n_removed bigint, kept_text string, removed array<struct<first:int,end:int>>")
    return out.withColumnRenamed("key", key)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(frames.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
