"""Spelling variants by a dictionary of trie-node pairs.

The corpus is reduced to its vocabulary (words and their counts) by one
aggregate. The vocabulary is sorted once forwards and once by reversed words,
and every distinct prefix (a node of the forward trie) and every distinct
suffix (a node of the reversed trie) gets an integer. From there on words are
integers: a word of L letters is posted under

- (prefix node, suffix node) around each of its L letters: the letter skipped;
- (prefix node, suffix node) at each of its L + 1 cuts: a letter inserted.

Two words that share a skipped pair differ in that one letter; a word whose
cut pair is another's skipped pair lacks that letter. These are exactly the
words one edit apart, with nothing to verify. A pair of nodes holds at most
one word per letter of the alphabet and one cut, so no group grows with the
corpus, and counts and best neighbours are taken per pair of nodes by a
window: no pairs of words are written out. Of a run of equal letters only the
first one counts as skipped towards the shorter word, so a neighbour counts
once however many of its letters could go.

``variants`` points every word to its neighbour of largest count where that
count is at least ``ratio`` times its own (ties: the smallest in code-point
order), and follows these pointers to the end by doubling. A step multiplies
the count by ``ratio``, so chains are short.

Node numbers are made per sorted partition; prefixes that go on across a
partition border are joined to the number they have before it. The driver
sees two words per partition, nothing else.

Null texts have no words; a null key counts as an empty one; repeated rows
count as often as they occur; very long words cost memory and postings in
proportion to their length. Empty tables give empty results. Further columns
are passed over, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reglink.llm import frames

# Letters of a word after A-Z is lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
# One run in so many loses a letter (the contract's damage).
DAMAGE = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PART_BITS = 40
_NUMBERED = "part int, rank bigint, n bigint, word string, nodes array<bigint>, kinds array<tinyint>"
# What a posting is: the whole word cut in two, a letter skipped, and a letter
# skipped that is the first of its run.
_CUT, _SKIP, _FIRST = 0, 1, 2


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, damage: int | None = None) -> DataFrame:
    """(word, n) of the lower-cased words with at least ``least_letters``
    letters and ``least_count`` occurrences. With ``damage``, one run in so
    many first loses a letter, by the crc32 of ``<key>:<run>``."""
    folded = F.translate(F.col(f"`{text}`").cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(folded, F.lit(f"({LETTERS})"), F.lit(1))).alias("word"),
    ).where(F.length("word") >= least_letters)
    if damage:
        runs = runs.withColumn("hash", F.crc32(F.concat_ws(":", "key", "word").cast("binary")))
        at = (F.col("hash") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("word", F.when(F.col("hash") % damage == 0, cut).otherwise(F.col("word"))).where(F.length("word") >= least_letters)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        half = (low + high + 1) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            high = half - 1
    return low


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted words of one partition: a prefix shared with the
    word before keeps its number, the others get the next ones."""
    before, path, next_node, place, part = "", [], 0, 0, None
    for batch in batches:
        part = batch.column("part")[0].as_py() if part is None and batch.num_rows else part
        base = (part or 0) << _PART_BITS
        words, ranks, nodes, kinds = batch.column("word").to_pylist(), [], [], []
        for word in words:
            shared = _common(before, word)
            path = path[:shared] + list(range(base + next_node, base + next_node + len(word) - shared))
            next_node += len(word) - shared
            nodes.append(path)
            kinds.append([_FIRST if not i or word[i] != word[i - 1] else _SKIP for i in range(len(word))])
            ranks.append(base + place)
            place += 1
            before = word
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), pa.array(ranks, pa.int64()), batch.column("n"), batch.column("word"), pa.array(nodes, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int8()))],
            names=["part", "rank", "n", "word", "nodes", "kinds"],
        )


def number_nodes(words: DataFrame) -> DataFrame:
    """(rank, n, word, nodes, kinds) of a table (word, n) of distinct words:
    ``nodes[d]`` is the number of the prefix of d + 1 letters, the same for
    all words that share it; ranks are in code-point order."""
    spark = words.sparkSession
    frames.ready(spark)
    ordered = words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
    numbered = frames.keep(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_number, _NUMBERED))
    borders = numbered.groupBy("part").agg(
        F.min_by("word", "rank").alias("first"), F.max_by("word", "rank").alias("last"), F.max_by("nodes", "rank").alias("path")
    )
    carried, before, path = [], "", []
    for row in sorted(borders.collect(), key=lambda r: r.part):
        shared = _common(before, row.first)
        here = path[:shared]
        if here:
            carried.append((row.part, here))
        base, before = row.part << _PART_BITS, row.last
        path = [here[x - base] if x - base < shared else x for x in row.path]
    if not carried:
        return numbered.drop("part")
    # One row per partition border at most.
    known = F.broadcast(spark.createDataFrame(carried, "part int, known array<bigint>"))
    base = F.col("part").cast("bigint") * (1 << _PART_BITS)
    renumber = F.transform("nodes", lambda x: F.when(x - base < F.size("known"), F.get("known", (x - base).cast("int"))).otherwise(x))
    return numbered.join(known, "part", "left").withColumn("nodes", F.when(F.col("known").isNull(), F.col("nodes")).otherwise(renumber)).drop("part", "known")


def postings(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """(prefix, suffix, kind, rank, n): every word under its skipped and its
    cut pairs of nodes. The empty prefix and suffix are node -1."""
    suffixes = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("tails"))
    root = F.array(F.lit(-1).cast("bigint"))
    both = forward.join(suffixes.hint("merge"), "word").select(
        "rank", "n", "kinds", F.length("word").alias("size"), F.concat(root, "nodes").alias("heads"), F.concat(root, "tails").alias("tails")
    )
    skipped = F.arrays_zip(F.slice("heads", F.lit(1), F.col("size")).alias("prefix"), F.reverse(F.slice("tails", F.lit(1), F.col("size"))).alias("suffix"), F.col("kinds").alias("kind"))
    cut = F.arrays_zip(F.col("heads").alias("prefix"), F.reverse("tails").alias("suffix"), F.array_repeat(F.lit(_CUT).cast("tinyint"), F.col("size") + 1).alias("kind"))
    return both.select("rank", "n", F.inline(F.concat(skipped, cut)))


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, word, n, n_near, best_n, best_rank) of a table (word, n) of
    distinct words: how many words are exactly one inserted, deleted or
    replaced letter away, and the one of largest count among them (ties: the
    smallest in code-point order); 0 and nulls where there is none."""
    forward = number_nodes(words)
    backward = number_nodes(words.select(F.reverse("word").alias("word"), "n"))
    pair = W.partitionBy("prefix", "suffix")
    whole = pair.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    is_cut = F.col("kind") == _CUT
    # Largest count first, then smallest rank; cuts after the skipped ones.
    order = pair.orderBy(is_cut, F.desc("n"), "rank")
    me = F.struct("n", (-F.col("rank")).alias("minus_rank"))
    seen = postings(forward, backward).select(
        "rank",
        "kind",
        F.count_if(~is_cut).over(whole).alias("skipped"),
        F.count_if(F.col("kind") == _FIRST).over(whole).alias("first_skipped"),
        F.max(F.when(is_cut, me)).over(whole).alias("cut"),
        F.max(F.when(~is_cut, me)).over(whole).alias("best"),
        F.row_number().over(order).alias("place"),
        F.lead(F.when(~is_cut, me)).over(order).alias("second"),
    )
    shorter = F.when((F.col("kind") == _FIRST) & F.col("cut").isNotNull(), 1).otherwise(0)
    others = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("best"))
    found = (
        seen.select(
            "rank",
            F.when(F.col("kind") == _CUT, F.col("first_skipped")).otherwise(F.col("skipped") - 1 + shorter).alias("n_near"),
            F.when(F.col("kind") == _CUT, F.col("best")).otherwise(F.greatest(others, "cut")).alias("best"),
        )
        .where(F.col("best").isNotNull())
        .groupBy("rank")
        .agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    )
    return forward.select("rank", "word", "n").join(found.hint("merge"), "rank", "left").select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("best.n").alias("best_n"), (-F.col("best.minus_rank")).alias("best_rank")
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct
    words with positive counts: the neighbour a word is a variant of (null if
    none), and the word where following forms ends (itself if none)."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms have to grow along a chain")
    known = frames.keep(neighbours(words))
    is_variant = F.col("best_n") >= ratio * F.col("n")
    links = frames.keep(known.where(is_variant).select("rank", F.col("best_rank").alias("form"), F.col("best_rank").alias("root")))
    while True:
        onward = links.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        step = links.join(onward.hint("merge"), "root", "left").select("rank", "form", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = frames.keep(step)
        frames.drop(links)
        links, done = moved.drop("moved"), not moved.where("moved").head(1)
        links._kept_at = moved._kept_at
        if done:
            break
    named = known.select(F.col("rank"), F.col("word"), F.col("n"))
    chains = (
        links.join(named.select(F.col("rank").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n")).hint("merge"), "form")
        .join(named.select(F.col("rank").alias("root"), F.col("word").alias("root_word")).hint("merge"), "root")
        .select("rank", "form_word", "root_word", "form_n")
    )
    return known.join(chains.hint("merge"), "rank", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six letters and five occurrences over all documents, after
    the contract's damage, grouped with the spellings one edit away."""
    words = frames.keep(count_words(frames.read(spark, sf_dir, "documents"), damage=DAMAGE))
    return variants(words)
