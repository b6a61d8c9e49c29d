"""Benchmark decontamination by a broadcast set of normalised word windows.

Every benchmark item is cut into windows of ``size`` words (an item with
fewer words, but not none, is one window of all its words). The hashes of
the distinct windows are broadcast once; each task slides the same windows
over its documents, looks the hashes up and verifies every hit word by word.
No document is shuffled. The broadcast is allowed up to ``max_windows``
windows, which is counted first; a larger benchmark goes through
``_scan_by_join``, which joins window hashes instead and gives the same rows.

Null or empty texts have no words, hence no hits and no items. Repeated
benchmark items each count under their own id; an item whose id is null has
windows (its words are hit) but adds no id. Repeated documents each give
their row. Further columns of either table are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import ALNUM, covered, find_words, slices, window_hashes, window_starts

SIZE = 13
MAX_WINDOWS = 2_000_000
RULE = 20  # contaminated from one hit word in 20

WINDOW_SCHEMA = "item string, n int, window binary"
HIT_SCHEMA = "{key} , n_words bigint, starts array<int>, lengths array<int>, items array<string>"


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = find_words(part.column("text"), ALNUM, True)
                ids, sizes, texts = [], [], []
                for i, item in enumerate(part.column("item").to_pylist()):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    n = min(size, b - a)
                    for at in sorted({w.joined(p, p + n) for p in range(a, b - n + 1)}) if n else ():
                        ids.append(item)
                        sizes.append(n)
                        texts.append(at)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), pa.array(texts, pa.binary())], names=["item", "n", "window"])

    return run


def benchmark_windows(benchmark: DataFrame, size: int = SIZE, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, n, window): the distinct normalised windows of each item."""
    frames.ready(benchmark.sparkSession)
    source = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(_item_windows(size), WINDOW_SCHEMA)


class WindowSet:
    """Windows by size: a bit table that rules out almost every hash, the
    sorted hashes, and the words behind each hash for the verification."""

    BITS = 22

    def __init__(self, rows: list[tuple[str | None, int, bytes]]):
        self.items: dict[bytes, list[str]] = {}
        by_size: dict[int, set[bytes]] = {}
        for item, n, window in rows:
            ids = self.items.setdefault(window, [])
            if item is not None and item not in ids:
                ids.append(item)
            by_size.setdefault(n, set()).add(window)
        self.tables = {}
        for n, windows in by_size.items():
            words = find_words(pa.array([w.decode("utf-8", "surrogateescape") for w in windows], pa.large_string()), ALNUM, True)
            table = np.zeros(1 << self.BITS, bool)
            hashes = window_hashes(words.hashes(), n)[words.first[:-1]]
            table[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
            self.tables[n] = (table, np.unique(hashes))

    def find(self, w) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Verified hits of a slice: first words, sizes, windows."""
        hashes, at, size, found = w.hashes(), [], [], []
        for n, (table, known) in self.tables.items():
            h = window_hashes(hashes, n)
            maybe = np.flatnonzero(table[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
            maybe = maybe[np.isin(h[maybe], known)]
            inside = window_starts(w.first, n) if len(maybe) else None
            for p in maybe:
                if inside[p] and (words := w.joined(p, p + n)) in self.items:
                    at.append(p)
                    size.append(n)
                    found.append(words)
        return np.array(at, np.int64), np.array(size, np.int64), found


def _scan(windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = find_words(part.column("text"), ALNUM, True)
                at, size, found = windows.value.find(w)
                row = np.searchsorted(w.first, at, "right") - 1
                starts, lengths, items = ([[] for _ in range(part.num_rows)] for _ in range(3))
                for p, n, words, r in zip(at, size, found, row, strict=True):
                    starts[r].append(int(p - w.first[r]))
                    lengths[r].append(int(n))
                    items[r].extend(windows.value.items[words])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(w.counts(), pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32())), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))],
                    names=["key", "n_words", "starts", "lengths", "items"],
                )

    return run


def _all_windows(sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=1 << 17):
                w = find_words(part.column("text"), ALNUM, True)
                row, start, size, window = [], [], [], []
                for n in sizes:
                    at = np.flatnonzero(window_starts(w.first, n))
                    row.append(np.searchsorted(w.first, at, "right") - 1)
                    start.append(at - w.first[row[-1]])
                    size.append(np.full(len(at), n))
                    window.extend(w.joined(p, p + n) for p in at)
                rows = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(pa.array(rows)), pa.array(np.concatenate(start), pa.int32()), pa.array(np.concatenate(size), pa.int32()), pa.array(window, pa.binary())],
                    names=["row", "start", "n", "window"],
                )

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            w = find_words(part.column("text"), ALNUM, True)
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("row"), pa.array(w.counts(), pa.int64())], names=["key", "row", "n_words"])


def _scan_by_join(source: DataFrame, windows: DataFrame, key_type: str) -> DataFrame:
    """The way for a benchmark too large to broadcast: an equi-join on the
    windows themselves. A window many documents share meets one row of the
    grouped benchmark, so the join never multiplies rows."""
    known = frames.keep(windows.groupBy("n", "window").agg(F.collect_set("item").alias("ids")))
    sizes = [r.n for r in known.select("n").distinct().collect()]  # 1..size
    rows = frames.keep(source.withColumn("row", F.monotonically_increasing_id()))
    hits = (
        rows.select("row", "text").mapInArrow(_all_windows(sizes), "row bigint, start int, n int, window binary")
        .join(known, ["n", "window"])
        .groupBy("row")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("lengths"), F.array_distinct(F.flatten(F.collect_list("ids"))).alias("items"))
    )
    none = F.array().cast("array<int>")
    return (
        rows.mapInArrow(_count_words, f"key {key_type}, row bigint, n_words bigint")
        .join(hits, "row", "left")
        .select("key", "n_words", F.coalesce("starts", none).alias("starts"), F.coalesce("lengths", none).alias("lengths"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", size: int = SIZE, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(key, n_words, starts, lengths, items) for every document: where
    benchmark windows occur (first word and number of words of each) and the
    ids of their items."""
    spark = docs.sparkSession
    frames.ready(spark)
    windows = benchmark_windows(benchmark, size)
    key_type = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    known = windows.limit(max_windows + 1).collect()
    if len(known) > max_windows:
        return _scan_by_join(source, windows, key_type)
    shared = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in known]))
    return source.mapInArrow(_scan(shared), HIT_SCHEMA.format(key=f"key {key_type}"))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.column("n_words").to_pylist()
        hit, digest, items = [], [], []
        for total, starts, lengths, ids in zip(n, batch.column("starts").to_pylist(), batch.column("lengths").to_pylist(), batch.column("items").to_pylist(), strict=True):
            hit.append(int(covered(total, np.array(starts, np.int64), np.array(lengths, np.int64)).sum()) if starts else 0)
            items.append(len(ids))
            digest.append(hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array(items, pa.int64()), pa.array(digest)], names=["key", "n_words", "n_hit", "n_items", "items_sha256"])


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **kw) -> DataFrame:
    """One row per document: key, n_words, n_hit (words inside hits), n_items,
    items_sha256 and the verdict ``contaminated``."""
    hits = find_hits(docs, benchmark, key, **kw)
    return _verdicts(hits, docs.schema[key].dataType.simpleString()).withColumnRenamed("key", key)


def _verdicts(hits: DataFrame, key_type: str) -> DataFrame:
    out = hits.mapInArrow(_judge, f"key {key_type}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (RULE * F.col("n_hit") >= F.col("n_words")))


def _mark(windows, text_index: int):
    """Batches with every column passed through and a verdict, or cut texts,
    added: n_words, n_hit and the text without the hit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, part_name := batch.schema.names[text_index]):
                w = find_words(part.column(part_name), ALNUM, True)
                at, size, _ = windows.value.find(w)
                hit = covered(len(w.starts), at, size) if len(at) else np.zeros(len(w.starts), bool)
                total = np.concatenate([[0], np.cumsum(hit)])
                cut = [_cut(text, w, i, hit) if total[w.first[i + 1]] > total[w.first[i]] else text for i, text in enumerate(part.column(part_name).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(w.counts(), pa.int64()), pa.array(total[w.first[1:]] - total[w.first[:-1]], pa.int64()), pa.array(cut, pa.string())], names=[*part.schema.names, "__n_words", "__n_hit", "__cut"])

    return run


def _cut(text: str, w, i: int, hit: np.ndarray) -> str:
    """The text without its hit words and the characters between them."""
    raw, base, out, last = text.encode(), int(w.offsets[i]), [], 0
    a, b = int(w.first[i]), int(w.first[i + 1])
    edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
    for p, q in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        out.append(raw[last:int(w.starts[a + p]) - base])
        last = int(w.ends[a + q - 1]) - base
    return b"".join([*out, raw[last:]]).decode()


def _cut_found(text_index: int):
    """Batches whose last two columns, the starts and lengths of the hits,
    give way to the text without the hit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, part_name := batch.schema.names[text_index]):
                w = find_words(part.column(part_name), ALNUM, True)
                cut = part.column(part_name).to_pylist()
                hit = np.zeros(len(w.starts), bool)
                for i, (starts, lengths) in enumerate(zip(part.column("starts").to_pylist(), part.column("lengths").to_pylist(), strict=True)):
                    if starts:
                        a, b = int(w.first[i]), int(w.first[i + 1])
                        hit[a:b] = covered(b - a, np.array(starts, np.int64), np.array(lengths, np.int64))
                        cut[i] = _cut(cut[i], w, i, hit)
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(cut, pa.string())], names=[*part.schema.names[:-2], "__cut"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, spans: bool = False, size: int = SIZE, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents, all columns as they were whatever their names, without
    the contaminated ones; with ``spans``, hit words are cut out of the
    documents that stay."""
    spark = docs.sparkSession
    frames.ready(spark)
    windows = benchmark_windows(benchmark, size)
    known = windows.limit(max_windows + 1).collect()
    names, text = docs.columns, frames.at(docs, "text")
    flat, at = frames.numbered(docs), int(text[1:])
    through = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    if len(known) > max_windows:
        rows = frames.keep(flat.withColumn("row", F.monotonically_increasing_id()))
        hits = find_hits(rows.select("row", F.col(text).alias("text")), benchmark, "row", size, max_windows)
        hits = frames.keep(hits) if spans else hits
        bad = _verdicts(hits, "bigint").where("contaminated").select(F.col("key").alias("row"))
        kept = rows.join(bad, "row", "left_anti")
        if not spans:
            return kept.drop("row").toDF(*names)
        where = hits.where(F.size("starts") > 0).select(F.col("key").alias("row"), "starts", "lengths")
        found = kept.join(where, "row", "left").drop("row")
        cut = found.mapInArrow(_cut_found(at), f"{through}, __cut string")
        return cut.select(*["__cut" if i == at else f"c{i}" for i in range(len(names))]).toDF(*names)
    shared = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in known]))
    marked = flat.mapInArrow(_mark(shared, at), f"{through}, __n_words bigint, __n_hit bigint, __cut string")
    kept = marked.where((F.col("__n_hit") == 0) | (RULE * F.col("__n_hit") < F.col("__n_words")))
    return kept.select(*["__cut" if spans and i == at else f"c{i}" for i in range(len(names))]).toDF(*names)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(frames.read(spark, sf_dir, "documents"), frames.read(spark, sf_dir, "benchmark"))
