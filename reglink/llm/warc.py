"""Merkle fixity audit of WARC replicas.

A replica is a set of records, each at an offset of an archive file. Record
bytes are hashed; the records of each ``RANGE_BYTES`` of a file, in offset
order, make a leaf; ``FANOUT`` consecutive nodes make a node of the next
level, up to one node per file and then, over the files in order, up to one
root. Two replicas with the same root hold the same bytes at the same
places. Where roots differ, the audit compares the children of differing
nodes only, level by level, and at last the records of differing ranges, so
the work below the leaves follows the damage and not the archive.

Every node has a bounded number of children, so no task gathers an unbounded
group. ``write_warc`` and ``read_warc`` keep replicas as WARC files;
``audit_files`` compares two of them, whatever the files' names.

A null page id, URL or body gives a record without that field or with an
empty body. Equal records are told apart by their offsets. An empty table
has no tree; two empty replicas are equal. Further columns are passed over.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reglink.llm import frames

FILE_BYTES = 1 << 20  # size an archive file is planned for
RANGE_BYTES = 1 << 16
FANOUT = 8
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
START = re.compile(rb"\r\n\r\n(?=WARC/\d)")
PIECE = 1 << 16  # compressed bytes read at a time


def record(page_id: Column, url: Column, body: Column, date: str = DATE) -> Column:
    """A WARC resource record, without the two line ends that close it."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    uri = F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url.cast("string"), F.lit("\r\n"))).otherwise(F.lit(""))
    name = F.when(page_id.isNotNull(), F.concat(F.lit("WARC-Record-ID: <urn:page:"), page_id.cast("string"), F.lit(">\r\n"))).otherwise(F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\n"), name, uri,
        F.lit(f"WARC-Date: {date}\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
    )


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", file_bytes: int = FILE_BYTES, copy=None) -> DataFrame:
    """(file, offset, length, key, digest): where each page's record lies in
    an archive of files of about ``file_bytes``, and its SHA-256. ``copy``, a
    function of the record and the key, gives the bytes another replica holds
    there (null: none); their ``copy_length`` and ``copy_digest`` are added."""
    size = lambda c: (F.octet_length(c) + len(END)).cast("bigint")
    rows = pages.select(F.col(key).alias("key"), record(F.col(key), F.col(url), F.col(body)).alias("record"))
    found = [] if copy is None else ["copy_length", "copy_digest"]
    if copy is not None:
        rows = rows.withColumn("copy", copy(F.col("record"), F.col("key"))).withColumns({"copy_length": size("copy"), "copy_digest": F.sha2("copy", 256)})
    rows = frames.keep(rows.select("key", size("record").alias("length"), F.sha2("record", 256).alias("digest"), *found))
    total = rows.agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    deal = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("digest"))), 1, 8), 16, 10).cast("bigint") % files
    rows = rows.withColumn("file", deal)
    before = F.sum("length").over(W.partitionBy("file").orderBy("key", "digest", "length").rowsBetween(W.unboundedPreceding, -1))
    return rows.select("file", F.coalesce(before, F.lit(0)).cast("bigint").alias("offset"), "length", "key", "digest", *found)


def _node(children: DataFrame, parent: list[Column]) -> DataFrame:
    """Hash of the ordered children of each parent."""
    return children.groupBy(*parent).agg(F.array_sort(F.collect_list(F.struct("order", "hash"))).alias("c")).select("file", "at", F.sha2(F.array_join(F.transform("c", lambda x: x.hash), ""), 256).alias("hash"))


class Tree:
    """``levels[k]`` holds (file, at, hash). The first levels are within
    files, the later ones over files (``at`` is 0 there)."""

    def __init__(self, leaves: DataFrame, ranges: int, files: int):
        self.levels, self.steps = [frames.keep(leaves)], []
        while ranges > 1:
            self._up(F.col("file"), F.floor(F.col("at") / FANOUT).cast("bigint"), "at")
            ranges = -(-ranges // FANOUT)
        while files > 1:
            self._up(F.floor(F.col("file") / FANOUT).cast("bigint"), F.lit(0).cast("bigint"), "file")
            files = -(-files // FANOUT)

    def _up(self, file: Column, at: Column, order: str) -> None:
        below = self.levels[-1].select(F.col(order).alias("order"), file.alias("file"), at.alias("at"), "hash")
        self.levels.append(frames.keep(_node(below, ["file", "at"])))
        self.steps.append((file, at))


def leaves(replica: DataFrame) -> DataFrame:
    at = F.floor(F.col("offset") / RANGE_BYTES).cast("bigint")
    rows = replica.select("file", at.alias("at"), F.struct("offset", "length").alias("order"), F.col("digest").alias("hash"))
    # Offsets belong to the leaf: the same records elsewhere are not the same.
    said = rows.withColumn("hash", F.concat_ws(":", F.col("order.offset"), F.col("order.length"), "hash"))
    return _node(said, ["file", "at"])


def _extent(*replicas: DataFrame) -> tuple[int, int]:
    """Ranges of the longest file and number of files, over all replicas."""
    ranges = files = 0
    for r in replicas:
        top = r.agg(F.max("offset"), F.max("file")).first()
        ranges = max(ranges, -1 if top[0] is None else top[0] // RANGE_BYTES + 1)
        files = max(files, 0 if top[1] is None else top[1] + 1)
    return max(ranges, 0), files


def differing(a: Tree, b: Tree) -> DataFrame:
    """(file, at) of the leaves whose hashes differ or that one side lacks,
    found from the root down."""
    bad = None
    for level in range(len(a.levels) - 1, -1, -1):
        left, right = a.levels[level], b.levels[level]
        if bad is not None:
            file, at = a.steps[level]
            left, right = (x.withColumn("up_file", file).withColumn("up_at", at).join(bad, ["up_file", "up_at"], "left_semi") for x in (left, right))
        both = left.select("file", "at", F.col("hash").alias("hash_a")).join(right.select("file", "at", F.col("hash").alias("hash_b")), ["file", "at"], "full")
        bad = frames.keep(both.where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))).select(F.col("file").alias("up_file"), F.col("at").alias("up_at")))
    return bad.select(F.col("up_file").alias("file"), F.col("up_at").alias("at"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """One row for each place where the replica's record is not the
    primary's: (file, offset, range, key, length, digest, found_length,
    found_digest, status). ``status``: corrupt (the bytes differ), missing
    (the replica has none there) or extra (the primary has none there)."""
    frames.ready(primary.sparkSession)
    primary, replica = frames.keep(primary), frames.keep(replica)
    ranges, files = _extent(primary, replica)
    trees = [Tree(leaves(x), ranges, files) for x in (primary, replica)]
    bad = differing(*trees)
    at = F.floor(F.col("offset") / RANGE_BYTES).cast("bigint")
    left, right = (x.withColumn("at", at).join(bad, ["file", "at"], "left_semi") for x in (primary, replica))
    right = right.select("file", "offset", F.col("at").alias("at_b"), F.col("key").alias("key_b"), F.col("length").alias("found_length"), F.col("digest").alias("found_digest"))
    both = left.withColumn("here", F.lit(True)).join(right, ["file", "offset"], "full")
    status = F.when(F.col("found_digest").isNull(), "missing").when(F.col("here").isNull(), "extra").otherwise("corrupt")
    return both.where(~(F.col("digest").eqNullSafe(F.col("found_digest")) & F.col("length").eqNullSafe(F.col("found_length")))).select(
        "file", "offset", F.coalesce("at", "at_b").alias("range"), F.coalesce("key", "key_b").alias("key"), "length", "digest", "found_length", "found_digest", status.alias("status")
    )


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", compression: str = "none") -> None:
    """Write the pages as WARC files, one or more per task. The text writer
    closes every record with its separator, which is WARC's own."""
    pages.select(record(F.col(key), F.col(url), F.col(body)).alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _unzip(content: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(offset, bytes, lost) of each readable stretch of a gzip file, which may
    have many members. A damaged member ends a stretch: what could be read of
    it belongs to the stretch, ``lost`` are its compressed bytes. The next
    member that begins with a record goes on at its own offset, which the
    damaged member's size field tells."""
    at, base, out = 0, 0, bytearray()
    while at < len(content):
        reader, fed, size, broken = zlib.decompressobj(31), at, len(out), False
        try:
            while not reader.eof and fed < len(content):
                out += reader.decompress(content[fed:fed + PIECE])
                fed += PIECE
        except zlib.error:
            broken = True
        if not broken and reader.eof:
            at = min(fed, len(content)) - len(reader.unused_data)
            # Zeros may pad the file.
            if content[at:at + 1] == b"\0" and not content[at:].strip(b"\0"):
                break
            continue
        stop = _member(content, at + 1)
        yield base, bytes(out), content[at:stop]
        told = int.from_bytes(content[stop - 4:stop], "little") if stop < len(content) else 0
        base, out, at = base + max(len(out), size + told), bytearray(), stop
    if out:
        yield base, bytes(out), b""


def _member(content: bytes, at: int) -> int:
    """Where the next gzip member that begins with a record begins."""
    while (at := content.find(b"\x1f\x8b\x08", at)) >= 0:
        try:
            if zlib.decompressobj(31).decompress(content[at:at + PIECE], 5) == b"WARC/":
                return at
        except zlib.error:
            pass
        at += 1
    return len(content)


def _records(raw: bytes) -> Iterator[tuple[int, bytes, bytes | None]]:
    """(offset, record, body) of each record, and of each damaged stretch
    between records, without body: one whose header cannot be read or whose
    length does not lead to a record's end, up to the next record."""
    at = 0
    while at < len(raw):
        head = raw.find(b"\r\n\r\n", at)
        size = re.search(rb"(?i)\r\nContent-Length: *(\d+)", raw[at:head]) if head >= 0 and raw.startswith(b"WARC/", at) else None
        end = head + 4 + int(size[1]) if size else -1
        if size and (end == len(raw) or raw.startswith(END.encode(), end) or raw.startswith(b"WARC/", end + len(END))):
            yield at, raw[at:end], raw[head + 4:end]
            at = end + len(END)
            continue
        after = START.search(raw, head + 4 if size else at)
        stop = after.start() if after else len(raw)
        if stop > at:
            yield at, raw[at:stop], None
        at = after.end() if after else stop


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            rows = []
            for base, raw, lost in _unzip(content) if content[:2] == b"\x1f\x8b" else [(0, content, b"")]:
                rows += [(base + at, record, body) for at, record, body in _records(raw)]
                if lost:
                    rows.append((base + len(raw), lost, None))
            yield pa.RecordBatch.from_arrays([pa.array([path.rpartition("/")[2]] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["name", "offset", "record", "body"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(name, offset, record, body) of every record of the WARC files in a
    folder. A damaged stretch is a row with the bytes found and no body; the
    records after it are read. A file is read whole, so files are to be of
    ordinary WARC size."""
    frames.ready(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_parse, "name string, offset bigint, record binary, body binary")


def file_numbers(*replicas: DataFrame) -> DataFrame:
    """(name, file): the files of all replicas, numbered from 0 by name."""
    names = reduce(DataFrame.union, [r.select("name") for r in replicas]).distinct().orderBy("name")
    return frames.keep(names.rdd.map(lambda r: r.name).zipWithIndex().toDF("name string, file bigint"))


def _files(records: DataFrame, numbers: DataFrame) -> DataFrame:
    key = F.regexp_extract(F.col("record").cast("string"), r"WARC-Record-ID: <([^>]*)>", 1)
    return records.join(numbers, "name").select("file", "offset", F.octet_length("record").cast("bigint").alias("length"), key.alias("key"), F.sha2("record", 256).alias("digest"))


def files_archive(records: DataFrame) -> DataFrame:
    """The records of ``read_warc`` in the form the audit takes. File numbers
    are those of this replica's names: ``audit_files`` compares two replicas."""
    frames.ready(records.sparkSession)
    return _files(records, file_numbers(records))


def audit_files(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """``audit`` of two replicas read by ``read_warc``, with the ``name`` of
    each file. A file is the same in both if its name is."""
    frames.ready(primary.sparkSession)
    numbers = file_numbers(primary, replica)
    return audit(_files(primary, numbers), _files(replica, numbers)).join(numbers, "file").select("name", "file", "offset", "range", "key", "length", "digest", "found_length", "found_digest", "status")


def aged(text: Column, key: Column) -> Column:
    """The bytes of a record in a mirror after years of use: of every fifty
    pages one has a changed character, one is torn (its second half blank)
    and one is lost. For the audit to have something to find."""
    turn, middle = F.pmod(key, F.lit(50)), F.floor(F.length(text) / 2).cast("int")
    other = F.when(F.substring(text, middle + 1, F.lit(1)) == "~", "!").otherwise("~")
    changed = F.concat(F.substring(text, F.lit(1), middle), other, F.substring(text, middle + 2, F.length(text)))
    torn = F.rpad(F.substring(text, F.lit(1), middle), F.length(text), F.lit(" "))
    return F.when(turn == 7, changed).when(turn == 19, torn).when(turn == 31, F.lit(None)).otherwise(text)


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = frames.keep(archive(frames.read(spark, sf_dir, "pages"), copy=aged))
    primary = both.select("file", "offset", "length", "key", "digest")
    mirror = both.where("copy_digest IS NOT NULL").select("file", "offset", F.col("copy_length").alias("length"), "key", F.col("copy_digest").alias("digest"))
    return audit(primary, mirror).withColumnRenamed("key", "page_id")
