"""Packing into optimal length buckets.

Texts are cut into pieces of at most ``max_length`` tokens. The histogram of
piece lengths over the whole corpus (at most ``max_length`` rows, whatever
the corpus) goes to the driver, where dynamic programming chooses at most
``buckets`` boundaries that minimise the padding of all pieces together.
Inside each bucket the pieces form batches of as many rows as the token
budget holds at the bucket's length.

A piece's place in its bucket is its rank under a content hash: pieces fall
into 4096 shards by that hash, are ranked within (bucket, shard), and the
shard's offset comes from counts (at most buckets x 4096 rows). So no task
sees a whole bucket, even where one length holds most pieces.

Texts without tokens (null or empty) give one row of length 0 without bucket
and batch. Equal rows are ranked one after the other. Further columns are
passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reglink.llm import frames

MAX_LENGTH = 2048
TOKEN_BUDGET = 16_384
BUCKETS = 8
SHARDS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """The default token count: white-space separated words."""
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def _bpe(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(SparkFiles.get(name))
        tokenizer.encode_special_tokens = True
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                texts = [x or "" for x in part.column("text").to_pylist()]
                n = [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("digest"), pa.array(n, pa.int64())], names=["key", "digest", "n_tokens"])

    return run


def lengths(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(key, digest, n_tokens) of every row. ``tokenizer`` is the path of a
    ``tokenizers`` vocabulary file; without it, words are counted."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.md5(body).alias("digest")
    if tokenizer is None:
        return docs.select(F.col(key).alias("key"), digest, word_count(text).alias("n_tokens"))
    spark = docs.sparkSession
    frames.ready(spark)
    spark.sparkContext.addFile(tokenizer)
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), digest, body.alias("text"))
    return source.mapInArrow(_bpe(tokenizer.rpartition("/")[2]), f"key {kind}, digest string, n_tokens bigint")


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Bucket lengths that minimise total padding: the exact optimum over all
    choices of at most ``buckets`` boundaries. Among equal ones, the choice
    whose last cut is smallest, and so on downwards."""
    if not histogram:
        return []
    length = np.array(sorted(histogram), np.int64)
    count = np.array([histogram[x] for x in length], np.float64)
    rows = np.concatenate([[0], np.cumsum(count)])
    tokens = np.concatenate([[0], np.cumsum(count * length)])
    n = len(length)
    # best[j]: least padding of the j shortest lengths with the buckets so far.
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cut = []
    for _ in range(min(buckets, n)):
        nxt, frm = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        nxt[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + length[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            frm[j] = int(np.argmin(cost))
            nxt[j] = cost[frm[j]]
        best = nxt
        cut.append(frm)
    out, j = [], n
    for frm in reversed(cut):
        if j:
            out.append(int(length[j - 1]))
            j = int(frm[j])
    return out[::-1]


def pieces(sizes: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Cut every text into consecutive token ranges of ``max_length``."""
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / max_length) - 1).cast("bigint")
    cut = sizes.select("key", "digest", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * max_length
    return cut.select("key", "digest", "piece", start.alias("start"), F.least(F.lit(max_length).cast("bigint"), F.col("n_tokens") - start).alias("length"))


def pack(sizes: DataFrame, max_length: int = MAX_LENGTH, budget: int = TOKEN_BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """(key, piece, start, length, bucket, batch, slot): for every piece its
    token range, the length its batch is padded to, the batch within that
    bucket and the place within the batch."""
    if budget < max_length:
        raise ValueError("the token budget must hold one piece of max_length")
    cut = frames.keep(pieces(sizes, max_length))
    full = cut.where(F.col("length") > 0)
    # At most max_length rows.
    histogram = {r.length: r.n for r in full.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ends = boundaries(histogram, buckets)
    if ends:
        bucket = F.coalesce(*[F.when(F.col("length") <= e, F.lit(e)) for e in ends]).cast("bigint")
    else:
        bucket = F.lit(None).cast("bigint")
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("piece"), F.col("digest")))
    placed = full.withColumn("bucket", bucket).withColumn("order", order).withColumn("shard", F.conv(F.substring("order", 1, 3), 16, 10).cast("int"))
    counts = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    # buckets x SHARDS rows at most: safe to broadcast.
    before = F.sum("n").over(W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("bucket", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("order", "key", "piece", "length"))
    ranked = placed.withColumn("rank", rank).join(F.broadcast(offsets), ["bucket", "shard"]).withColumn("place", F.col("before") + F.col("rank") - 1)
    rows = F.floor(F.lit(budget) / F.col("bucket")).cast("bigint")
    out = ranked.select("key", "piece", "start", "length", "bucket", F.floor(F.col("place") / rows).cast("bigint").alias("batch"), (F.col("place") % rows).cast("bigint").alias("slot"))
    none = F.lit(None).cast("bigint")
    return out.unionByName(cut.where(F.col("length") <= 0).select("key", "piece", "start", "length", none.alias("bucket"), none.alias("batch"), none.alias("slot")))


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(lengths(frames.read(spark, sf_dir, "documents"))).withColumnRenamed("key", "doc_id")
