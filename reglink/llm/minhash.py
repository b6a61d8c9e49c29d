"""Near-duplicate components by an inverted join over signature coordinates.

1. Texts become sets of word shingles. Texts with equal sets form a class;
   everything after works on classes, so copies cost one row each.
2. A class has a MinHash signature of ``COORDINATES`` values. Two sets of
   Jaccard similarity s agree on a binomial number of coordinates, so a pair
   at the threshold agrees on at least m of them but for a chance of
   ``MISS`` (m is computed from the binomial tail).
3. A class is posted under (coordinate, value) pairs. Prefix merging: under a
   global order of the pairs, two classes that share m of K pairs share one
   of the first K - m + 1 of each, so only those are posted. The order is by
   ascending frequency (of a fixed-size sketch of all pairs), so the pairs of
   a passage that many texts share come last and are not posted.
4. Collisions are counted by list. A list is never expanded into all pairs:
   in every round a few members of each list (leaders) meet the members that
   are in another component; a leader that has met them leaves the list.
   Skip merging: lists whose members are all in one component are done. The
   rounds end when no list spans two components, which is when every
   colliding pair has been compared or is connected already.
   The first two leaders of a long list are pivots: their exact similarity
   with every member rules out, by the triangle inequality of Jaccard
   distances, most pairs of a member near one and a member far from it. What
   is left of long lists after that is posted once more under the rarest
   shingles of the sets themselves, by the prefix filter of an exact join.
   Sizes and positions rule pairs out (length and positional filter): if x
   and y elements of two sets are left from their first common one on, they
   have min(x, y) in common at most, and a link needs a number that follows
   from the two sizes. Texts with edits of their own that are just below the
   threshold are told apart by this without a comparison.
5. Met pairs that agree on m coordinates are confirmed on the whole sets, and
   components grow by contraction along the confirmed links.

A list that a third of the classes stand in is split by adaptive joins (both
sides of each join are stored tables), and n members need a few times n
comparisons once they are connected.

Null and empty texts have no words: no set, linked with nothing. Equal rows
are one class. Null ids are never the smallest; a component of null ids only
has a null id. Further columns are passed over.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import PLAIN, find_words, mix, slices, window_hashes

COORDINATES = 128
MISS = 1e-6
SKETCH_BITS = 20
HEAD_PAIRS = 256
SMALL = 16  # in lists up to this long every member leads at once; in longer
# ones one member does, then about three more, fifteen more, and so on
_U = np.uint64


def least_matches(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest m such that fewer than m of the coordinates agree with a
    chance of at most ``miss`` at this similarity."""
    below, m = 0.0, 0
    while m < coordinates:
        below += math.comb(coordinates, m) * similarity**m * (1 - similarity) ** (coordinates - m)
        if below > miss:
            break
        m += 1
    return m


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


class Shingles:
    """The shingle hashes of each text of a slice, repeats included."""

    def __init__(self, text: pa.Array, size: int):
        w = find_words(text, PLAIN, True)
        hashes = w.hashes()
        n = w.counts()
        windows = window_hashes(hashes, size)
        # Text i has the windows first[i] : first[i] + n - size + 1; a short
        # text is one shingle of all its words, put behind the windows.
        short = np.flatnonzero((n > 0) & (n < size))
        extra = [window_hashes(hashes[w.first[i]:w.first[i + 1]], int(n[i])) for i in short]
        self.all = np.concatenate([windows, *extra]) if extra else windows
        self.begin = w.first[:-1].copy()
        self.count = np.maximum(n - size + 1, 0)
        self.begin[short], self.count[short] = len(windows) + np.arange(len(short)), 1

    def of(self, i: int) -> np.ndarray:
        """The set of text i, sorted."""
        return np.unique(self.all[self.begin[i]:self.begin[i] + self.count[i]])

    def signatures(self, rows: np.ndarray) -> np.ndarray:
        """Minimum of every coordinate for the given (non-empty) texts."""
        # reduceat over begin and end of each; every second result is a text's.
        edges = np.stack([self.begin[rows], self.begin[rows] + self.count[rows]], axis=1).ravel()
        padded = np.append(self.all, _U(0))
        out = np.empty((len(rows), COORDINATES), _U)
        for c, a in enumerate(_multipliers()):
            value = padded * a
            value ^= value >> _U(32)
            value *= _U(0xD6E8FEB86659FD93)
            out[:, c] = np.minimum.reduceat(value, edges)[::2]
        return out


def _classes(size: int, signed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = Shingles(part.column("text"), size)
                n, digest = [], []
                for i in range(part.num_rows):
                    own = s.of(i)
                    n.append(len(own))
                    digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                columns = {"key": part.column("key"), "n": pa.array(n, pa.int64()), "class": pa.array(digest, pa.binary())}
                if signed:
                    rows = np.flatnonzero(s.count > 0)
                    signature = [x.tobytes() for x in _stored(s.signatures(rows))] if len(rows) else []
                    columns = {k: v.take(pa.array(rows)) for k, v in columns.items()} | {"signature": pa.array(signature, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _slots(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of every (coordinate, value) pair."""
    return mix(signature ^ mix(np.arange(COORDINATES, dtype=_U))[None, :])


def _stored(signature: np.ndarray) -> np.ndarray:
    """The low 48 bits of every value: enough to tell values apart."""
    return np.ascontiguousarray(signature.view(np.uint8).reshape(len(signature), COORDINATES, 8)[:, :, :6])


def _signatures(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES, 6)
    out = np.zeros((len(raw), COORDINATES, 8), np.uint8)
    out[:, :, :6] = raw
    return out.view(_U).reshape(len(raw), COORDINATES)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            slot = _slots(_signatures(batch.column("signature").slice(begin, 4096))) >> _U(64 - SKETCH_BITS)
            total += np.bincount(slot.ravel().astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    for begin in range(0, len(at), 1 << 16):
        part = at[begin:begin + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], names=["slot", "n"])


def _post(sketch, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                if not part.num_rows:
                    continue
                keys = _slots(_signatures(part.column("signature")))
                n = sketch.value[(keys >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((keys, n), axis=1)[:, :prefix]
                posted = np.take_along_axis(keys, order, axis=1)
                at = pa.array(np.repeat(np.arange(part.num_rows), posted.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(posted.ravel().view(np.int64)), part.column("class").take(at), part.column("n").take(at)], names=["list", "class", "size"])

    return run


def _brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """16 bits of every coordinate: a pair that agrees on 64 agrees here."""
    for batch in batches:
        s = _signatures(batch.column("signature")).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array([x.tobytes() for x in s], pa.binary())], names=["class", "brief"])


def _match(m: int):
    """Pairs that agree on m coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, COORDINATES) for c in ("brief_a", "brief_b"))
            near = (a == b).sum(axis=1) >= m
            yield batch.select(["a", "b", "pivot", "head"]).filter(pa.array(near))

    return run


def _bodies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                s = Shingles(part.column("text"), size)
                raw = part.column("text").cast(pa.binary()).to_pylist()
                digest = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own := s.of(i)) else None for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(digest, pa.binary()), pa.array([pack.compress(x or b"") for x in raw], pa.binary())], names=["key", "class", "body"])

    return run


def _confirm(size: int, per: int, of: int):
    """Rows (head, a, b, pivot, body) in order: the body of a head class
    first, then the bodies of the classes it met, each compared with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, head = zstandard.ZstdDecompressor(), None
        for batch in batches:
            met, share, yes = [], [], []
            for i, (b, body) in enumerate(zip(batch.column("b"), batch.column("body"), strict=True)):
                own = Shingles(pa.array([unpack.decompress(body.as_buffer())], pa.binary()).cast(pa.large_string()), size).of(0)
                if not b.is_valid:
                    head = own
                    continue
                common = len(np.intersect1d(head, own, assume_unique=True))
                union = len(head) + len(own) - common
                met.append(i)
                share.append(common / union)
                yes.append(of * common >= per * union)
            found = batch.select(["a", "b", "pivot"]).take(pa.array(met, pa.int64()))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(share, pa.float64()), pa.array(yes, pa.bool_())], names=["a", "b", "pivot", "share", "linked"])

    return run


def confirm(near: DataFrame, bodies: DataFrame, size: int, per: int, of: int) -> DataFrame:
    """(a, b, pivot, share, linked) of met pairs (a, b, pivot, head), by their
    whole sets. A head's pairs are dealt to tasks ``HEAD_PAIRS`` at a time, by
    their measured number; its body travels once for each of these parts,
    not with every pair."""
    parts = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    other = F.when(F.col("head") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    sizes = near.groupBy("head").agg(F.ceil(F.count("*") / HEAD_PAIRS).alias("parts"))
    met = near.join(sizes.hint("merge"), "head").select("a", "b", "pivot", "head", other.alias("class"), "parts")
    met = met.withColumn("part", F.pmod(F.xxhash64("class"), "parts")).drop("parts")
    heads = met.select("head", "part").distinct().join(bodies.withColumnRenamed("class", "head"), "head")
    rows = heads.unionByName(met.join(bodies, "class").drop("class"), allowMissingColumns=True)
    ordered = rows.repartition(parts, "head", "part").sortWithinPartitions("head", "part", F.asc_nulls_first("b"))
    return ordered.select("head", "a", "b", "pivot", "body").mapInArrow(_confirm(size, per, of), "a binary, b binary, pivot boolean, share double, linked boolean")


def _shingle_sketch(size: int):
    """How often each shingle occurs in the given bodies, by hashed slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for x in batch.column("body").to_pylist():
                own = Shingles(pa.array([unpack.decompress(x)], pa.binary()).cast(pa.large_string()), size).of(0)
                np.add.at(total, (own >> _U(64 - SKETCH_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["slot", "n"])

    return run


def _rare(size: int, per: int, of: int, sketch):
    """Each class under its rarest shingles, as many as the prefix filter of
    an exact similarity join asks for: a linked set shares one of them. With
    each, the size of the set and how much of it is left from there on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            lists, sizes, left, names = [np.empty(0, _U)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for name, x in zip(batch.column("class").to_pylist(), batch.column("body").to_pylist(), strict=True):
                own = Shingles(pa.array([unpack.decompress(x)], pa.binary()).cast(pa.large_string()), size).of(0)
                order = np.lexsort((own, sketch.value[(own >> _U(64 - SKETCH_BITS)).astype(np.int64)]))
                lists.append(own[order[: len(own) + per * len(own) // -of + 1]])
                sizes.append(np.full(len(lists[-1]), len(own)))
                left.append(len(own) - np.arange(len(lists[-1])))
                names += [name] * len(lists[-1])
            columns = [np.concatenate(lists).view(np.int64), pa.array(names, pa.binary()), np.concatenate(sizes), np.concatenate(left)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["list", "class", "size", "rest"])

    return run


def _counters(df: DataFrame, kernel) -> np.ndarray:
    """A summed sketch: 2 ** SKETCH_BITS counters, whatever the corpus."""
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in df.mapInArrow(kernel, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_batches():
        out[r.column("slot").to_numpy()] = r.column("n").to_numpy()
    return out


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): one root for each
    connected component. In each round every node moves to the neighbour (or
    itself) that comes first in an order drawn anew for the round, and edges
    move with their ends, until none is left."""
    nodes = frames.keep(edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("root")))
    left, turn, spent = edges.select("a", "b"), 0, []
    while True:
        left = frames.keep(left.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        frames.drop(*spent)
        if left.isEmpty():
            frames.drop(left)
            return nodes
        both = left.union(left.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("o"), F.col(c).alias("c"))  # noqa: B023, E731
        move = frames.keep(both.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a"))).alias("m")).select(F.col("a").alias("from"), F.col("m.c").alias("to")))
        older, nodes = nodes, frames.keep(nodes.join(move, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")))
        spent = [older, left, move]
        left = left.join(move.toDF("a", "a2"), "a", "left").join(move.toDF("b", "b2"), "b", "left").select(F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b"))
        turn += 1


def merge(roots: DataFrame | None, new: DataFrame) -> DataFrame:
    """The roots after further edges: only roots are contracted again."""
    if roots is None:
        return contract(new)
    lifted = (
        new.join(roots.toDF("a", "root_a"), "a", "left").join(roots.toDF("b", "root_b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    contracted = contract(lifted)
    moved = contracted.toDF("root", "to")
    old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    fresh = moved.toDF("node", "root").join(roots.select("node"), "node", "left_anti").select("node", "root")
    out = frames.keep(old.union(fresh))
    frames.drop(roots, contracted)
    return out


def links(source: DataFrame, size: int, per: int, of: int) -> DataFrame | None:
    """(class, root) of every class that is linked with another. ``source``
    has key and text."""
    spark = source.sparkSession
    kind = source.schema["key"].dataType.simpleString()
    m = least_matches(per / of)
    classes = frames.keep(
        source.mapInArrow(_classes(size, True), f"key {kind}, n bigint, class binary, signature binary")
        .groupBy("class").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    )
    sketch = _counters(classes.select("signature"), _sketch)
    posted = classes.select("class", "n", "signature").mapInArrow(_post(spark.sparkContext.broadcast(sketch), COORDINATES - m + 1), "list bigint, class binary, size bigint")
    shared = frames.keep(posted.groupBy("list").agg(F.count("*").alias("n")).where("n > 1"))
    lists = frames.keep(posted.join(shared.hint("merge"), "list").select("list", "class", "size"))
    briefs = frames.keep(classes.select("class", "signature").mapInArrow(_brief, "class binary, brief binary"))
    reps = frames.keep(classes.select("class", "rep"))
    frames.drop(classes, shared)
    none = F.lit(None).cast("double")
    previous, lists = lists, lists.withColumns({"rest": F.col("size"), "share0": none, "share1": none})
    # A pair whose sets begin to agree with a and b elements left agrees on
    # min(a, b) at most; a link of sizes x and y needs this many of them.
    enough = lambda rest, x, y: (per + of) * rest >= per * (x + y)
    seen = roots = bodies = None
    turn, reach = 0, 1 - per / of + 1e-9
    while True:
        placed = lists if roots is None else lists.join(roots.withColumnRenamed("node", "class"), "class", "left")
        placed = placed.select("list", "class", "size", "rest", "share0", "share1", (F.col("class") if roots is None else F.coalesce("root", "class")).alias("root"))
        spans = placed.groupBy("list").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), (F.min("class") if turn == 0 else F.max_by("class", F.coalesce("share0", F.lit(0.0)))).alias("head"))
        spans = frames.keep(spans.where("low != high").select("list", "n", "head"))
        if spans.isEmpty():
            break
        open_lists = frames.keep(placed.join(spans, "list"))
        draw = F.pmod(F.xxhash64("list", "class", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        more = 4.0**turn - 1 if turn > 1 else 0.0
        lead = (F.col("class") == F.col("head")) | (F.col("n") <= SMALL) | (draw < F.lit(more) / F.col("n"))
        leaders = open_lists.where(lead).select("list", F.col("class").alias("leader"), F.col("root").alias("leader_root"), *[F.col(c).alias(f"leader_{c}") for c in ("size", "rest", "share0", "share1")])
        # Two texts whose distances to a pivot of the list differ by more than
        # the distance of a link cannot be linked (triangle inequality).
        apart = [F.coalesce(F.abs(F.col(c) - F.col(f"leader_{c}")) > reach, F.lit(False)) for c in ("share0", "share1")]
        # In the first two rounds the leader of a long list is its pivot and
        # meets every member: some member first, then the one nearest to it.
        pivot = (F.col("n") > SMALL) & (F.col("leader") == F.col("head")) if turn < 2 else F.lit(False)
        meet = enough(F.least("rest", "leader_rest"), F.col("size"), F.col("leader_size")) & (F.col("root") != F.col("leader_root")) & ~(apart[0] | apart[1])
        pairs = (
            open_lists.join(leaders, "list").where((meet | pivot) & (F.col("class") != F.col("leader")))
            .select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b"), pivot.alias("pivot"), "leader")
            .groupBy("a", "b").agg(F.max("pivot").alias("pivot"), F.min("leader").alias("head"))
        )
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = frames.keep(pairs.select("a", "b", "pivot", "head"))
        before, seen = seen, frames.keep(pairs.select("a", "b") if seen is None else seen.union(pairs.select("a", "b")))
        frames.drop(before)
        # Pairs that agree on m coordinates, and all pairs with a pivot.
        near = pairs.where("NOT pivot").join(briefs.toDF("a", "brief_a"), "a").join(briefs.toDF("b", "brief_b"), "b").mapInArrow(_match(m), "a binary, b binary, pivot boolean, head binary")
        near = frames.keep(near.union(pairs.where("pivot")) if turn < 2 else near)
        # Members stay in a long list until they have led: a leader has met
        # all it could meet in its list.
        stay = open_lists.where(~lead)
        if turn == 0:
            # The texts of the classes that are to be compared, now or later.
            wanted = near.select(F.col("a").alias("class")).union(near.select("b")).union(stay.select("class")).distinct()
            wanted = frames.keep(reps.join(wanted, "class"))
            bodies = frames.keep(
                source.mapInArrow(_bodies(size), f"key {kind}, class binary, body binary").alias("s")
                .join(wanted.hint("merge").alias("r"), (F.col("s.class") == F.col("r.class")) & F.col("key").eqNullSafe(F.col("rep")))
                .select("s.class", "body").dropDuplicates(["class"])
            )
            frames.drop(reps, wanted)
        compared = frames.keep(confirm(near, bodies, size, per, of))
        new = compared.where("linked").select("a", "b")
        if roots is None or not new.isEmpty():
            roots = merge(roots, new)
        lists = stay.select("list", "class", "size", "rest", "share0", "share1")
        if turn < 2:
            ends = compared.where("pivot").select("a", "b", F.col("share").alias("found"))
            lists = (
                stay.withColumn("a", F.least("class", "head")).withColumn("b", F.greatest("class", "head"))
                .join(ends, ["a", "b"], "left")
                .select("list", "class", "size", "rest", *[(F.col("found") if i == turn else F.col(c)).alias(c) for i, c in enumerate(("share0", "share1"))])
            )
        if turn == 1:
            # What is left of the long lists: texts alike in too many
            # coordinates and yet not linked. Their classes are posted anew,
            # under the rarest of their own shingles.
            rest = frames.keep(bodies.join(lists.select("class").distinct(), "class"))
            rare = frames.keep(rest.mapInArrow(_rare(size, per, of, spark.sparkContext.broadcast(_counters(rest.select("body"), _shingle_sketch(size)))), "list bigint, class binary, size bigint, rest bigint"))
            again = rare.groupBy("list").agg(F.count("*").alias("n"), F.min("size").alias("least")).where("n > 1").select("list", "least")
            # A member stays if it could meet the smallest set of the list
            # that is large enough for it.
            other = F.greatest(F.col("least"), F.floor(F.col("size") * per / of))
            lists = rare.join(again, "list").where(enough(F.col("rest"), F.col("size"), other)).drop("least").withColumns({"share0": none, "share1": none})
        lists = frames.keep(lists)
        frames.drop(spans, open_lists, pairs, near, compared, previous, *([rest, rare] if turn == 1 else []))
        previous = lists
        turn += 1
    frames.drop(spans, seen, previous, briefs, bodies, *([reps] if bodies is None else []))
    return roots


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, per: int = 85, of: int = 100) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key
    linked with it, itself included), class_id (equal for equal sets) and
    kept. Texts are linked if of * |intersection| >= per * |union|."""
    spark = docs.sparkSession
    frames.ready(spark)
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    roots = links(source, size, per, of)
    members = frames.keep(source.mapInArrow(_classes(size, False), f"key {kind}, n bigint, class binary"))
    classes = frames.keep(members.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("least")))
    named = classes.select("class", "least", F.col("class").alias("root"))
    if roots is not None:
        named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").select("class", "least", F.coalesce("root", "class").alias("root"))
    named = frames.keep(named)
    ids = frames.keep(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = frames.keep(named.join(ids, "root").select("class", "component_id"))
    out = members.join(named, "class", "left").select(
        F.col("key"), F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"), F.hex("class").alias("class_id"),
    )
    return out.withColumn("kept", F.col("key").eqNullSafe(F.col("component_id"))).withColumnRenamed("key", key)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, per: int = 80, of: int = 100) -> DataFrame:
    """The documents, one of each group of near duplicates (the one with the
    smallest key, null first, then text hash); of rows equal in key and text,
    whatever their other columns, one stays. All columns as they were."""
    at_key, at_text = frames.at(docs, key), frames.at(docs, text)
    named = F.when(F.col(at_key).isNull(), "").otherwise(F.concat(F.lit("="), F.col(at_key).cast("string")))
    rows = frames.numbered(docs).withColumns({"id": named, "hash": F.xxhash64(F.col(at_text).cast("string"))})
    source = rows.select(F.struct(F.col(at_key).alias("key"), "id", "hash").alias("row"), F.col(at_text).alias("body"))
    kept = near_duplicates(source, "row", "body", size, per, of).where("kept").select("row.id", "row.hash").distinct()
    out = rows.join(frames.keep(kept).hint("merge"), ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    return out.drop("id", "hash").toDF(*docs.columns)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(frames.read(spark, sf_dir, "documents")).drop("class_id")
