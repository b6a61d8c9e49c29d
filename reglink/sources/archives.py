"""Zip archives of delimited files, expanded and parsed on the executors.

The registries ship as zip files (one per municipality, one per month).
``expand_archives`` lists them with Spark's ``binaryFile`` source (paths and
lengths only), reads each zip's central directory on the executors to list
its members, packs the members into tasks of even size and streams each
member's lines in bounded chunks (``mapInPandas``). ``integrate_archives``
goes on from state folders of archives to a table with a state column. Parsing the lines is then native
(``from_csv``), and the success/failure tally is an ordinary aggregate, so
one broken archive never stops the others.

Limits: one member is one deflate stream, read sequentially by one task
(in bounded memory); lines are split before CSV parsing, so quoted fields
spanning lines are not supported. Executors open archives through
``pyarrow.fs`` (local, HDFS, S3, GCS URIs).
"""

from __future__ import annotations

import csv
import io
import zipfile
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reglink.operators.profile import ref
from reglink.session import ensure_checkpoint_dir, ship_package
from reglink.sources.schemas import STATE_FOLDER_GLOB
from reglink.sources.store import ROWS_PER_FILE, partition_sizes, replace_partitions

# --- fixed values -----------------------------------------------------------
STATUS_OK = "ok"
STATUS_ERROR = "error"
# State label in the path of an archive: the letters of its NN_XX folder.
ARCHIVE_STATE_REGEX = r"/[0-9]{2}_([A-Z]{2})/[^/]*$"
# Case-insensitive archive suffix for the file listing.
ARCHIVE_GLOB = "*.[zZ][iI][pP]"
# ----------------------------------------------------------------------------

EXPANDED_SCHEMA = (
    "archive string, member string, line_no bigint, line string, status string, message string"
)
MEMBERS_SCHEMA = "archive string, member string, size bigint, status string, message string"
MEMBERS_SCHEMA_COLS = ["archive", "member", "size", "status", "message"]
_COLS = ["archive", "member", "line_no", "line", "status", "message"]

# Unpacked bytes of a task's members, and shards of the listing in ``pack_members``.
TASK_BYTES = 256 * 1024 * 1024
_SHARDS = 256
# Lines per emitted pandas frame: bounds the Arrow batches whatever the member size.
_CHUNK = 10_000
# Damaged, truncated and encrypted members raise errors of many types (zlib's
# own among them); whatever one raises, it fails alone.
_ERRORS = Exception


def _same_header(line: str, expected: str) -> bool:
    """Field names are compared, not text: a byte-order mark and quotes go."""
    sep = next((c for c in ";,|\t" if c in expected), ";")
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
    return [x.strip() for x in names] == expected.split(sep)


class _RandomAccess(io.RawIOBase):
    """A pyarrow input file seen as a raw Python file.

    ``zipfile`` probes positions before the start of small files and expects
    ``OSError`` there; pyarrow raises ``ArrowInvalid`` instead.
    """

    def __init__(self, f):
        super().__init__()
        self._f = f

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, pos: int, whence: int = 0) -> int:
        try:
            return self._f.seek(pos, whence)
        except ValueError as exc:
            raise OSError(str(exc)) from exc

    def tell(self) -> int:
        return self._f.tell()

    def readinto(self, b) -> int:
        data = self._f.read(len(b))
        b[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self._f.close()
        super().close()


def _open(uri: str):
    """Buffered random-access file of ``uri`` on the executor (local, HDFS, S3, GCS...)."""
    import pyarrow.fs as pafs

    if uri.startswith("s3a://") or uri.startswith("s3n://"):
        uri = "s3://" + uri.split("://", 1)[1]
    fs, path = pafs.FileSystem.from_uri(uri)
    return io.BufferedReader(_RandomAccess(fs.open_input_file(path)), buffer_size=1 << 20)


def _status_frame(archive: str, member: str | None, status: str, message: str | None) -> pd.DataFrame:
    return pd.DataFrame(
        {"archive": [archive], "member": [member], "line_no": [None], "line": [None], "status": [status], "message": [message]},
        columns=_COLS,
    ).astype({"line_no": "Int64"})


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: members of each archive from its central directory only."""
    for pdf in batches:
        for path in pdf["path"]:
            try:
                with _open(path) as f, zipfile.ZipFile(f) as zf:
                    infos = [i for i in zf.infolist() if not i.is_dir()]
            except _ERRORS as exc:
                yield pd.DataFrame([(path, None, None, STATUS_ERROR, f"{type(exc).__name__}: {exc}")], columns=MEMBERS_SCHEMA_COLS)
                continue
            for start in range(0, len(infos), _CHUNK):
                chunk = infos[start:start + _CHUNK]
                yield pd.DataFrame(
                    [(path, i.filename, i.file_size, STATUS_OK, None) for i in chunk], columns=MEMBERS_SCHEMA_COLS
                )
            yield pd.DataFrame([(path, None, None, STATUS_OK, f"{len(infos)} members")], columns=MEMBERS_SCHEMA_COLS)



def _read_members(encoding: str, expected_header: str | None = None):
    """mapInPandas body: stream the lines of each (archive, member) in chunks.

    With ``expected_header`` a member whose first line differs is not read:
    it gets an ``error`` status row instead, so a reordered file can never
    shift values into the wrong columns.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for archive, member in zip(pdf["archive"], pdf["member"]):
                try:
                    with _open(archive) as f, zipfile.ZipFile(f) as zf, zf.open(member) as raw:
                        # Lines end at "\n" only; a trailing "\r" is dropped below.
                        text = io.TextIOWrapper(raw, encoding=encoding, errors="replace", newline="\n")
                        chunk: list[str] = []
                        start = 0
                        for line in text:
                            line = line[:-1] if line.endswith("\n") else line
                            line = line[:-1] if line.endswith("\r") else line
                            if expected_header is not None and start == 0 and not chunk and not _same_header(line, expected_header):
                                yield _status_frame(archive, member, STATUS_ERROR, f"header mismatch: {line!r}")
                                break
                            chunk.append(line)
                            if len(chunk) == _CHUNK:
                                yield _lines_frame(archive, member, start, chunk)
                                start += len(chunk)
                                chunk = []
                        if chunk:
                            yield _lines_frame(archive, member, start, chunk)
                except _ERRORS as exc:
                    yield _status_frame(archive, member, STATUS_ERROR, f"{type(exc).__name__}: {exc}")

    return read


def _lines_frame(archive: str, member: str, start: int, chunk: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "archive": archive,
            "member": member,
            "line_no": range(start, start + len(chunk)),
            "line": chunk,
            "status": STATUS_OK,
            "message": None,
        },
        columns=_COLS,
    )


def list_archives(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length, content) of every ``.zip`` under ``path``.

    Select only ``path`` and ``length`` and no file content is read. A folder
    holding no archive gives an empty frame; a missing folder raises Spark's
    path-not-found error.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", ARCHIVE_GLOB)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)


def list_members(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(archive, member, size, status, message): one row per member plus one
    status row per archive (NULL member), read from each zip's central
    directory only; an unreadable archive gives one ``error`` row."""
    ship_package(spark)
    return list_archives(spark, path, recursive).select("path").mapInPandas(_list_members, MEMBERS_SCHEMA)


def pack_members(members: DataFrame, task_bytes: int) -> DataFrame:
    """(archive, member, size, task) of a listing: tasks 0, 1, ... of even
    unpacked size.

    Members of ``task_bytes`` or more have a task of their own; the others
    are laid end to end and cut every ``task_bytes``, so such a task holds
    less than twice that. The running total is taken within shards of the
    listing and moved on by the totals of the shards before, so no task sees
    the whole listing. Empty members count one byte.
    """
    if task_bytes < 1:
        raise ValueError("task_bytes must be positive")
    listed = members.select("archive", "member", "size", F.greatest(F.col("size"), F.lit(1)).alias("weight"))
    listed = listed.withColumn("shard", F.pmod(F.xxhash64("archive", "member"), F.lit(_SHARDS)))
    small, large = listed.where(F.col("weight") < task_bytes), listed.where(F.col("weight") >= task_bytes)

    def running(rows: DataFrame, measure: Column) -> DataFrame:
        within = Window.partitionBy("shard").orderBy("archive", "member").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy("shard").agg(F.sum(measure).alias("total"))
        # One row per shard.
        offsets = totals.select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
        return rows.withColumn("before", F.coalesce(F.sum(measure).over(within), F.lit(0))).join(F.broadcast(offsets), "shard")

    begin = small.agg(F.coalesce(F.floor((F.sum("weight") - 1) / task_bytes) + 1, F.lit(0))).scalar()
    cut = running(small, F.col("weight")).withColumn("task", F.floor((F.col("before") + F.col("offset")) / task_bytes))
    alone = running(large, F.lit(1)).withColumn("task", begin + F.col("before") + F.col("offset"))
    return cut.unionByName(alone).select("archive", "member", "size", F.col("task").cast("int").alias("task"))


def expand_archives(
    spark: SparkSession,
    path: str,
    encoding: str = "utf-8",
    recursive: bool = False,
    task_bytes: int | None = None,
    expected_header: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every line of every member of every archive under ``path``, plus status rows.

    (archive, member, line_no, line, status, message). Line rows have status
    ``ok``. Status rows have a NULL line: one per archive from the listing
    (NULL member, ``ok`` or ``error``), and one per member that failed while
    being read (status ``error``).

    Members, not archives, are the unit of work. They are packed into tasks
    by their unpacked sizes from the listing (``pack_members``): at most
    ``task_bytes`` a task (default: 256 MB, or less where ``partitions``
    tasks, by default the shuffle partitions, would otherwise not all get
    work), with a task of its own for a larger member. Each member is streamed in bounded chunks, so neither a
    large archive nor a large member is ever held whole in memory. A member
    is one deflate stream, so one member stays one task's work.
    ``expected_header`` rejects members whose first line differs (status
    ``error``, no lines).
    """
    # The listing (one small row per member) feeds the sizes, the members and
    # the status rows. Checkpointed eagerly to the shared folder, it is
    # computed once while being written: each archive's central directory is
    # read once (one request per archive on object storage), and the lineage
    # is cut.
    ensure_checkpoint_dir(spark)
    listing = list_members(spark, path, recursive).checkpoint(eager=True)
    members = listing.where(F.col("member").isNotNull())
    if task_bytes is None:
        total = members.agg(F.sum("size")).first()[0] or 0
        task_bytes = min(TASK_BYTES, max(1, -(-total // (partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    packed = pack_members(members, task_bytes)
    tasks = 1 + (packed.agg(F.max("task")).first()[0] or 0)
    lines = packed.repartitionById(tasks, "task").select("archive", "member").mapInPandas(_read_members(encoding, expected_header), EXPANDED_SCHEMA)
    archive_status = listing.where(F.col("member").isNull()).select(
        "archive", "member", F.lit(None).cast("bigint").alias("line_no"), F.lit(None).cast("string").alias("line"),
        "status", "message",
    )
    return lines.unionByName(archive_status)


def archive_lines(expanded: DataFrame) -> DataFrame:
    """The line rows of ``expand_archives`` output, without the lines that a
    member gave before it failed."""
    failed = expanded.where(F.col("line").isNull() & F.col("member").isNotNull() & (F.col("status") == STATUS_ERROR)).select("archive", "member").distinct()
    lines = expanded.where(F.col("line").isNotNull()).select("archive", "member", "line_no", "line")
    return lines.join(failed, ["archive", "member"], "left_anti")


def ddl(schema: StructType) -> str:
    """DDL text of a flat schema (``a bigint, b string``)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def parse_lines(
    lines: DataFrame,
    schema: StructType,
    sep: str = ";",
    header: bool = True,
    keep_source: bool = False,
    keep_rejects: bool = False,
) -> DataFrame:
    """Parse delimited lines natively with ``from_csv`` under ``schema``.

    With ``header`` the first line of every member is skipped. Bad fields are
    NULL (permissive), as with the file reader; ``keep_rejects`` adds the
    ``_corrupt_record`` column holding the raw line of every short, long or
    mistyped row (``registry.rejected_summary`` counts them).
    """
    from reglink.sources.registry import CORRUPT_COLUMN

    rows = lines.where(F.col("line_no") > 0) if header else lines
    options = {"sep": sep}
    if keep_rejects:
        schema = StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType(), True)])
        options.update({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    parsed = rows.select(
        "archive",
        "member",
        F.from_csv(F.col("line"), ddl(schema), options).alias("__r"),
    )
    fields = [F.col(f"__r.`{f.name}`").alias(f.name) for f in schema.fields]
    return parsed.select(*(["archive", "member"] if keep_source else []), *fields)


def archive_state(archive: str = "archive") -> Column:
    """State label of an archive from its folder (``.../11_RO/x.zip``: RO);
    NULL outside a state folder."""
    label = F.regexp_extract(archive, ARCHIVE_STATE_REGEX, 1)
    return F.when(label != "", label)


def ingest_tally(expanded: DataFrame, label: str | None = None) -> DataFrame:
    """(n_archives, n_succeeded, n_failed): an archive failed when its listing
    or any of its members failed. Aggregates the status rows only (one per
    archive plus one per failed member). With ``label``, one row per state
    folder under that name."""
    keys = [archive_state().alias(label)] if label else []
    per_archive = (
        expanded.where(F.col("line").isNull())
        .groupBy(*keys, "archive")
        .agg(F.max((F.col("status") == STATUS_ERROR).cast("int")).alias("failed"))
    )
    return per_archive.groupBy(*([ref(label)] if label else [])).agg(
        F.count(F.lit(1)).alias("n_archives"),
        F.count_if(F.col("failed") == 0).alias("n_succeeded"),
        F.count_if(F.col("failed") == 1).alias("n_failed"),
    )


def ingest_failures(expanded: DataFrame) -> DataFrame:
    """(archive, member, message) of every archive or member that could not be read."""
    return expanded.where(F.col("line").isNull() & (F.col("status") == STATUS_ERROR)).select(
        "archive", "member", "message"
    )


def ingest_archives(
    spark: SparkSession,
    path: str,
    schema: StructType,
    staging: str,
    sep: str = ";",
    header: bool = True,
    encoding: str = "utf-8",
    check_header: bool = True,
    keep_rejects: bool = False,
    keep_source: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Expand once into a Parquet table under ``staging``, then parse and tally.

    The unpacking (the only Python step) runs once and its output is written
    to the shared folder, which cuts the lineage: parsing, the tally and any
    retry after a lost executor read the written table instead of unpacking
    the archives again. With a header, each member's first line must name
    the schema's fields in order (``check_header``), as the folder reader
    checks files. Returns (parsed rows, tally).
    """
    expected = sep.join(f.name for f in schema.fields) if header and check_header else None
    expand_archives(spark, path, encoding, expected_header=expected).write.mode("overwrite").parquet(staging)
    expanded = spark.read.parquet(staging)
    parsed = parse_lines(archive_lines(expanded), schema, sep, header, keep_source, keep_rejects)
    return parsed, ingest_tally(expanded)


def integrate_archives(
    spark: SparkSession,
    raw_dir: str,
    out: str,
    schema: StructType,
    staging: str,
    label: str = "UF",
    sep: str = ";",
    encoding: str = "utf-8",
    check_header: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
    task_bytes: int | None = None,
) -> DataFrame:
    """State folders of archives (``11_RO/*.zip``) to one Parquet table under
    ``out``, partitioned by state; returns the tally of archives per state.

    The archives are unpacked once into ``staging``. A member's state comes
    with its lines from the archive's path. The states that are found replace
    theirs in the table and leave others alone, in files of about
    ``rows_per_file`` rows (lines counted per archive from the staged table,
    of which only two columns are read for it). Archives outside state
    folders are not read; ones that cannot be read are failures in the tally
    and give no rows.
    """
    if label in schema.fieldNames():
        raise ValueError(f"{label} is a field of the files: choose another label")
    expected = sep.join(f.name for f in schema.fields) if check_header else None
    folders = f"{raw_dir.rstrip('/')}/{STATE_FOLDER_GLOB}"
    expand_archives(spark, folders, encoding, expected_header=expected, task_bytes=task_bytes).write.mode("overwrite").parquet(staging)
    expanded = spark.read.schema(EXPANDED_SCHEMA).parquet(staging)
    lines = archive_lines(expanded).where(F.col("line_no") > 0).withColumn("state", archive_state())
    fields = [F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]
    row_no = "row_no"
    while row_no in (*schema.fieldNames(), label):
        row_no += "_"
    rows = lines.select(F.from_csv("line", ddl(schema), {"sep": sep}).alias("r"), "state", F.xxhash64("archive", "member", "line_no").alias("row_no"))
    # Lines per archive first: a state is cut from each archive's path once.
    per_archive = archive_lines(expanded).where(F.col("line_no") > 0).groupBy("archive").agg(F.count(F.lit(1)).alias("n"))
    sizes = partition_sizes(per_archive.select(archive_state().alias("state"), "n"), "state", F.sum("n"))
    replace_partitions(rows.select(*fields, F.col("state").alias(label), F.col("row_no").alias(row_no)), out, label, rows_per_file, sizes, spread=row_no)
    return ingest_tally(expanded, label)
