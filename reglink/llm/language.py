"""Language identification by the nearest of several centroids per language.

A text is the normalised TF-IDF vector of its hashed byte trigrams (ASCII
letters folded, other ASCII replaced by spaces), taken over the whole text;
document frequencies are those of all labelled texts.
Each language has up to ``CENTROIDS`` centroids, found by spherical k-means
over a bounded sample of its labelled texts (at most ``PER_LANGUAGE`` distinct
rows a language, those with the smallest hashes of key and text). A text gets the language of the
centroid with the largest cosine; ``rejected`` tells texts that lie farther
from that centroid than its own texts did in training.

Every language with a labelled text is learned. Up to ``BLOCK`` centroids are
broadcast and the texts are never shuffled. More are dealt into blocks of about
half that size; the texts are scored against one block at a time, and each
takes the best over all blocks, by a shuffle of scores without texts.

Null texts and texts without a letter are ``und`` with score 0, and so is
every text when nothing labelled was given. Null languages and null texts are
never learned from. Repeated rows each give their row; further columns are
passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import FOLD, slices

BUCKETS = 1 << 13
CENTROIDS = 4
PER_LANGUAGE = 400  # size of the sample of one language
BLOCK = 1024  # centroids broadcast at once
SMALL = 100_000  # languages whose shares are broadcast
SPARE = 2  # times the sample is drawn before it is cut to its size
ROUNDS = 8
ROWS = 128  # texts that are vectors at the same time
SLACK = 0.05  # added to a centroid's radius

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SEEN = FOLD.copy()
_SEEN[:0x80][~_LETTER[:0x80]] = 0x20


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch):
        for begin in range(0, part.num_rows, ROWS):
            yield part.slice(begin, ROWS)


def _buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    text = text.cast(pa.large_string())
    text = text.fill_null("") if text.null_count else text
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def counts(text: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """Trigram counts, one row per text."""
    raw, offsets = _buffer(text)
    seen = _SEEN[raw].astype(np.uint32)
    out = np.zeros((len(offsets) - 1, buckets), np.float32)
    if len(seen) < 3:
        return out
    code = (seen[:-2] << np.uint32(16)) | (seen[1:-1] << np.uint32(8)) | seen[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - (buckets - 1).bit_length())).astype(np.int32)
    for i in range(len(out)):
        part = bucket[offsets[i]:max(offsets[i], offsets[i + 1] - 2)]
        if len(part):
            out[i] = np.bincount(part, minlength=buckets)
    return out


def vectors(text: pa.Array, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts(text, len(idf))) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=v, where=norm > 0)


def has_letter(text: pa.Array) -> np.ndarray:
    raw, offsets = _buffer(text)
    letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
    out = letters[offsets[1:]] > letters[offsets[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in raw[offsets[i]:offsets[i + 1]].tobytes().decode())
    return out


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for part in _pieces(batch):
            total += (counts(part.column("text")) > 0).sum(axis=0)
            n += part.num_rows
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["bucket", "n"])


def cluster(v: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: centroids, and the
    smallest cosine of any member with each."""
    mean = v.mean(axis=0)
    seeds = [int(np.argmax(v @ mean))]
    while len(seeds) < min(k, len(v)):
        near = (v @ v[seeds].T).max(axis=1)
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-6:
            break
        seeds.append(far)
    c = v[seeds].copy()
    for _ in range(rounds):
        best = np.argmax(v @ c.T, axis=1)
        for j in range(len(c)):
            if (best == j).any():
                s = v[best == j].sum(axis=0)
                c[j] = s / max(np.linalg.norm(s), 1e-12)
    near = v @ c.T
    best = np.argmax(near, axis=1)
    return c, np.array([near[best == j, j].min() if (best == j).any() else 1.0 for j in range(len(c))])


def _fit(idf):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        # In an order of its own: the same rows give the same centroids.
        part = part.sort_values(["order", "text"])
        v = vectors(pa.array(part["text"], pa.large_string()), idf.value)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pd.DataFrame({"lang": [], "centroid": [], "radius": []})
        c, radius = cluster(v)
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centroid": [x.astype(np.float32).tobytes() for x in c], "radius": radius})

    return run


class Model:
    """``table`` has the ``n`` centroids, or is None with none."""

    def __init__(self, idf: np.ndarray, table: DataFrame | None = None, n: int = 0):
        self.idf, self.table, self.n = idf, table, n

    def blocks(self, limit: int) -> Iterator[Block]:
        """The centroids, those of one language in one block."""
        if self.n <= limit:
            yield Block(self.idf, self.table.collect() if self.n else [])
            return
        count = -(-2 * self.n // limit)
        dealt = self.table.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(count)))
        for i in range(count):
            rows = dealt.where(F.col("block") == i).drop("block").collect()
            if rows:
                yield Block(self.idf, rows)


class Block:
    def __init__(self, idf: np.ndarray, rows: list):
        rows = sorted(rows, key=lambda r: (r.lang, bytes(r.centroid)))
        self.idf = idf
        self.lang = [r.lang for r in rows]
        self.centroids = np.array([np.frombuffer(r.centroid, np.float32) for r in rows]) if rows else None
        self.radius = np.array([r.radius for r in rows])


def _place() -> Column:
    return F.pmod("order", F.lit(1 << 40))


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """Of each language the distinct rows that come first by hash. Equal rows
    are one before any row moves, so a hot key or text fills no task."""
    rows = rows.groupBy("lang", "order").agg(F.min("text").alias("text"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(_place(), "order"))
    return frames.keep(rows.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank"))


def fit(labelled: DataFrame, key: Column, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE) -> Model:
    """Train on labelled rows. ``key`` decides, by its hash with the text's,
    which rows are in the sample; it takes no part in a prediction."""
    spark = labelled.sparkSession
    frames.ready(spark)
    source = labelled.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(key, F.col(text).cast("string")).alias("order")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Distinct rows, counted within a few percent.
    size = frames.keep(source.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("n")))
    n = size.count()
    if not n:
        return Model(np.ones(BUCKETS, np.float32))
    size = F.broadcast(size) if n <= SMALL else size
    drawn = source.join(size, "lang").where(_place() < (SPARE * per_language / F.col("n")) * (1 << 40)).select(source.columns)
    sample = _sample(drawn, per_language)
    # A statistic of all learnable rows; at most BUCKETS + 1 rows come back.
    seen = {r.bucket: r.n for r in source.select("text").mapInArrow(_document_frequency, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = seen.pop(-1, 0)
    idf = np.zeros(BUCKETS, np.float32)
    for b, n in seen.items():
        idf[b] = np.log((1 + total) / (1 + n)) + 1
    shared = spark.sparkContext.broadcast(idf)
    table = frames.keep(sample.groupBy("lang").applyInPandas(_fit(shared), "lang string, centroid binary, radius double"))
    return Model(idf, table, table.count())


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in _pieces(batch):
                text = part.column("text")
                ok = has_letter(text)
                lang, score, out = ["und"] * len(ok), np.zeros(len(ok)), np.ones(len(ok), bool)
                if m.centroids is not None and ok.any():
                    near = vectors(text, m.idf) @ m.centroids.T
                    best = np.argmax(near, axis=1)
                    top = near[np.arange(len(ok)), best]
                    score = np.where(ok, np.clip(top, 0.0, 1.0), 0.0)
                    out = ~ok | (top < m.radius[best] - SLACK)
                    lang = [m.lang[b] if o else "und" for b, o in zip(best, ok, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out)], names=["key", "held_out", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: Model, key: str = "doc_id", held_out: Column | None = None, text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) for every row."""
    spark = docs.sparkSession
    frames.ready(spark)
    kind = docs.schema[key].dataType.simpleString()
    schema = "key {}, held_out boolean, lang_pred string, score double, rejected boolean"
    source = docs.select(F.col(key).alias("key"), (F.lit(None).cast("boolean") if held_out is None else held_out).alias("held_out"), F.col(text).cast("string").alias("text"))
    if model.n <= block:
        (whole,) = model.blocks(block)
        return source.mapInArrow(_predict(spark.sparkContext.broadcast(whole)), schema.format(kind)).withColumnRenamed("key", key)
    row = F.struct("key", F.monotonically_increasing_id().alias("row"))
    rows = frames.keep(source.withColumn("key", row))
    found = []
    for one in model.blocks(block):
        shared = spark.sparkContext.broadcast(one)
        found.append(frames.keep(rows.mapInArrow(_predict(shared), schema.format(rows.schema["key"].dataType.simpleString()))))
        shared.unpersist()
    # Of equal scores the first language, as within a block.
    best = F.min(F.struct((-F.col("score")).alias("far"), "lang_pred", "rejected", "key", "held_out")).alias("best")
    best = reduce(DataFrame.unionAll, found).groupBy("key.row").agg(best)
    return best.select(F.col("best.key.key").alias(key), "best.held_out", "best.lang_pred", (-F.col("best.far")).alias("score"), "best.rejected")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identify(docs, fit(docs.where(~held_out), F.col("doc_id")), held_out=held_out)
