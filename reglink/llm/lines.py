"""Line deduplication by content-defined chunks of lines.

Every line is hashed; a chunk ends after a line where the hash of the last
``WINDOW`` line hashes is 0 modulo ``DIVISOR`` (and at the end of the text).
A boundary depends on the lines just before it only, so an inserted line
moves the boundaries next to it and no others: copies of a passage are cut
alike wherever they stand. A chunk of at least ``LEAST`` lines that occurs
more than once in the corpus stays at its first place, by (id, text hash,
place), and is removed from all others.

Chunks are grouped by their bytes: the grouping key is the chunk itself, so
equal hashes alone never remove anything. Only the 128-bit hashes of the
repeated chunks then travel back to the documents. Copies collapse before
the shuffle, and the join back is on a stored table, so a chunk that a third
of all texts hold is split over tasks.

Null texts stay null; an empty text is one empty line. A text all of whose
chunks go becomes the empty text; no row is dropped. Rows with the same id
and the same text share one fate. Further columns go through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames

DIVISOR = 3
WINDOW = 2
LEAST = 2


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once per row: as a lambda's
    variable it cannot be written out again wherever the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(text: Column, divisor: int = DIVISOR) -> Column:
    """The chunks of a text in order, each an array of lines."""

    def cut(lines: Column) -> Column:
        def ends(hashes: Column) -> Column:
            def ends_at(i: Column) -> Column:
                last = F.slice(hashes, F.greatest(i - WINDOW + 1, F.lit(1)), F.least(i, F.lit(WINDOW)))
                value = F.conv(F.substring(F.md5(F.array_join(last, "")), 1, 8), 16, 10).cast("bigint")
                return (i == F.size(lines)) | (value % divisor == 0)

            return F.filter(F.sequence(F.lit(1), F.size(lines)), ends_at)

        def parts(end: Column) -> Column:
            start = F.concat(F.array(F.lit(0)), F.slice(end, F.lit(1), F.size(end) - 1))
            return F.zip_with(start, end, lambda a, b: F.slice(lines, a + 1, b - a))

        return _let(F.transform(lines, lambda x: F.md5(x)), lambda h: _let(ends(h), parts))

    return F.when(text.isNotNull(), _let(F.split(text, "\n", -1), cut))


def _hashes() -> list[Column]:
    return [F.xxhash64("chunk").alias("h1"), F.xxhash64(F.lit("second"), F.col("chunk")).alias("h2")]


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR, least: int = LEAST) -> DataFrame:
    """(__id, __hash, __removed): for every text that loses chunks, the
    places of those among its chunks."""
    body = F.col(f"`{text}`").cast("string")
    # The outer form: it does not ask for the array once more to test its size.
    places = (
        docs.select(F.col(key).alias("__id"), F.xxhash64(body).alias("__hash"), F.posexplode_outer(chunks(body, divisor)).alias("place", "lines"))
        .where(F.size("lines") >= least)
        .select("__id", "__hash", "place", F.array_join("lines", "\n").alias("chunk"))
    )
    place = F.struct("__id", "__hash", "place")
    repeated = places.groupBy("chunk").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select(*_hashes(), "first")
    repeated = frames.keep(repeated)
    return (
        places.select(*_hashes(), "__id", "__hash", "place")
        .join(repeated, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("__id", "__hash")
        .agg(F.collect_set("place").alias("__removed"))
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR, least: int = LEAST, counts: tuple[str, str] = ("__n_lines", "__n_removed")) -> DataFrame:
    """The documents with repeated chunks cut out of ``text``, and the numbers
    of lines before and removed under the names of ``counts``, which must not
    be columns of ``docs``; its other columns may have any names."""
    if {c.lower() for c in counts} & {c.lower() for c in docs.columns}:
        raise ValueError(f"{counts} are columns of the documents: name the counts otherwise")
    flat, at_key, at_text = frames.numbered(docs), frames.at(docs, key), frames.at(docs, text)
    body = F.col(at_text).cast("string")
    gone = frames.keep(removals(flat, at_key, at_text, divisor, least)).select(F.col("__id").alias("__gone_id"), F.col("__hash").alias("__gone_hash"), "__removed")
    # Sorted and merged at every size: no broadcast that holds only while small.
    joined = flat.join(gone.hint("merge"), F.col(at_key).eqNullSafe(F.col("__gone_id")) & (F.xxhash64(body) == F.col("__gone_hash")), "left")

    def split(all_chunks: Column) -> Column:
        stays = F.filter(all_chunks, lambda c, i: ~F.array_contains("__removed", i))
        lost = F.filter(all_chunks, lambda c, i: F.array_contains("__removed", i))
        return F.struct(F.array_join(F.flatten(stays), "\n").alias("text"), F.size(F.flatten(lost)).cast("bigint").alias("n"))

    joined = joined.withColumn("__split", F.when(F.col("__removed").isNotNull(), _let(chunks(body, divisor), split)))
    rebuilt = F.when(F.col("__removed").isNull(), F.col(at_text)).otherwise(F.col("__split.text"))
    out = joined.select(
        *[rebuilt.alias(c) if c == at_text else F.col(c) for c in flat.columns],
        F.when(body.isNull(), 0).otherwise(F.size(F.split(body, "\n", -1))).cast("bigint").alias("__n_lines"),
        F.coalesce("__split.n", F.lit(0)).cast("bigint").alias("__n_removed"),
    )
    return out.toDF(*docs.columns, *counts)


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, counts=("n_lines", "n_removed"))
