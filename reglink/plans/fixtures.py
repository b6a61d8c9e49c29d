"""Registry-shaped inputs derived from the driver's tables.

The linkage and profiling operators expect an establishment registry and an
address registry. The driver ships TPC-H-like tables instead, so the whole
``part`` table is split into two registries that share real, repeated keys:
even ``p_partkey`` rows become establishments, odd ones addresses (every row
lands on exactly one side; ``whole`` gives a side every row, for queries that
look at one side only). ``p_name`` (64 values) plays the name, brand and
type the street parts, size the house number; size and brand also make a
postal code and coordinates, written the way the establishment file writes
them (comma decimals, some unparseable).

Each builder has a SQL twin in ``reglink.plans.catalog`` that DuckDB runs as
the oracle; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _brand_no():
    return F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")


def _even(part: DataFrame) -> DataFrame:
    return part.where(F.pmod(F.col("p_partkey"), F.lit(2)) == 0)


def _odd(part: DataFrame) -> DataFrame:
    return part.where(F.pmod(F.col("p_partkey"), F.lit(2)) == 1)


def establishments(part: DataFrame, whole: bool = False) -> DataFrame:
    """Left registry: establishment rows with string coordinates and an int postal code."""
    size = F.col("p_size").cast("string")
    brand = _brand_no().cast("string")
    return (part if whole else _even(part)).select(
        F.col("p_partkey").alias("CO_UNIDADE"),
        F.col("p_name").alias("NO_FANTASIA"),
        F.concat_ws(" ", "p_brand", "p_type").alias("NO_LOGRADOURO"),
        size.alias("NU_ENDERECO"),
        (F.col("p_size") * F.lit(1000) + _brand_no()).alias("CO_CEP"),
        F.when(F.col("p_type") == "PROMO", F.lit("S/N"))
        .otherwise(F.concat(F.lit("-"), size, F.lit(",25")))
        .alias("NU_LATITUDE"),
        F.when(F.col("p_type") == "LARGE", F.concat(F.lit("1."), brand, F.lit(",5")))
        .otherwise(F.concat(F.lit("-"), brand, F.lit(",")))
        .alias("NU_LONGITUDE"),
    )


def addresses(part: DataFrame, whole: bool = False) -> DataFrame:
    """Right registry: address rows with street parts, int number, string postal code."""
    return (part if whole else _odd(part)).select(
        F.col("p_partkey").alias("COD_UNICO_ENDERECO"),
        F.col("p_name").alias("DSC_ESTABELECIMENTO"),
        F.col("p_brand").alias("NOM_TIPO_SEGLOGR"),
        F.lit(None).cast("string").alias("NOM_TITULO_SEGLOGR"),
        F.col("p_type").alias("NOM_SEGLOGR"),
        F.col("p_size").alias("NUM_ENDERECO"),
        F.lpad((F.col("p_size") * F.lit(1000) + _brand_no()).cast("string"), 8, "0").alias("CEP"),
        (-(F.col("p_size") + F.lit(0.25))).alias("LATITUDE"),
        (-_brand_no().cast("double")).alias("LONGITUDE"),
        F.when(F.col("p_size") <= 45, F.lit(5)).otherwise(F.lit(9)).alias("COD_ESPECIE"),
    )


def dotted_establishments(part: DataFrame, whole: bool = False) -> DataFrame:
    """Establishments of which every third writes its coordinates with a dot
    and no comma at the end, as plain numbers."""
    plain = F.pmod(F.floor(F.col("CO_UNIDADE") / 2), F.lit(3)) == 0

    def dot(c: str):
        return F.when(plain, F.regexp_replace(F.regexp_replace(c, ",$", ""), ",", ".")).otherwise(F.col(c))

    est = establishments(part, whole)
    return est.withColumns({c: dot(c) for c in ("NU_LATITUDE", "NU_LONGITUDE")})


def rough_establishments(part: DataFrame) -> DataFrame:
    """Establishments whose numbers have leading zeros and blanks and whose
    latitudes are a little off: they match after normalising only."""
    est = establishments(part)
    return est.withColumns(
        {
            "NU_ENDERECO": F.concat(F.lit(" 00"), "NU_ENDERECO"),
            "NU_LATITUDE": F.when(F.col("NU_LATITUDE") == "S/N", "S/N").otherwise(F.regexp_replace("NU_LATITUDE", ",25$", ",27")),
        }
    )


def messy_registries(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both registries with a doctor's name (an initial ``R`` in its midst)
    and an avenue: the addresses write them out, of the establishments only
    every third does, the others abbreviate in two ways."""
    way, name, kind = F.pmod(F.floor(F.col("CO_UNIDADE") / 2), F.lit(3)), F.col("NO_FANTASIA"), F.col("p_type")
    est = establishments(part).join(part.select(F.col("p_partkey").alias("CO_UNIDADE"), "p_type"), "CO_UNIDADE")
    est = est.withColumns(
        {
            "NO_FANTASIA": F.when(way == 0, F.concat(F.lit("DOUTOR JOAO R "), F.upper(name)))
            .when(way == 1, F.concat(F.lit("  dr. Joao r. "), F.lower(name), F.lit(" #")))
            .otherwise(F.concat(F.lit("Dr  Joao R\t"), name)),
            "NO_LOGRADOURO": F.when(way == 0, F.concat(F.lit("AVENIDA "), kind)).when(way == 1, F.concat(F.lit("av. "), F.lower(kind))).otherwise(F.concat(F.lit("Av "), kind, F.lit("!"))),
        }
    ).drop("p_type")
    adr = addresses(part).withColumns({"DSC_ESTABELECIMENTO": F.concat(F.lit("DOUTOR JOAO R "), F.upper("DSC_ESTABELECIMENTO")), "NOM_TIPO_SEGLOGR": F.lit("AVENIDA")})
    return est, adr


def profiled_part(part: DataFrame) -> DataFrame:
    """``part`` with NULLs, empty strings and "no value" markers derived in.

    The driver tables hold none of these, so a profile over them would check
    nothing: sizes above 48 lose their name, size 1 loses its size, Brand#13
    becomes an empty string, PROMO becomes VAGO and small SMALL parts a
    longer text containing the other marker.
    """
    return part.select(
        "p_partkey",
        F.when(F.col("p_size") > 48, F.lit(None)).otherwise(F.col("p_name")).alias("p_name"),
        F.when(F.col("p_brand") == "Brand#13", F.lit("")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_type") == "PROMO", F.lit("VAGO"))
        .when((F.col("p_type") == "SMALL") & (F.col("p_size") < 10), F.lit("RUA SEM DENOMINACAO"))
        .otherwise(F.col("p_type"))
        .alias("p_type"),
        F.when(F.col("p_size") == 1, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"),
        "p_retailprice",
    )


# --- staged files --------------------------------------------------------------
# Queries over delimited files or archives first write driver tables into the
# shared checkpoint folder (once per session and table), then run the operator
# over what was written.

_STAGED: dict[tuple, str] = {}

ORDERS_FILE_FIELDS = [
    ("o_orderkey", "long"),
    ("o_custkey", "long"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]


def orders_file_schema():
    from pyspark.sql.types import StructField, StructType, TimestampNTZType

    from reglink.sources.schemas import struct_from

    fields = []
    for name, kind in ORDERS_FILE_FIELDS:
        if kind == "timestamp_ntz":
            fields.append(StructField(name, TimestampNTZType(), True))
        else:
            fields.append(struct_from([(name, kind)]).fields[0])
    return StructType(fields)


def stage_state_folders(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as ``;`` files in one folder per status: ``11_FF``, ``12_OO``...

    One partitioned write, then each ``o_orderstatus=X`` folder is renamed to a
    state-style name (metadata only). A stray ``cnes`` folder of other files
    sits next to them, as a downloaded establishment dump would.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "state_folders")
    if key in _STAGED:
        return _STAGED[key]
    from reglink.session import staging_dir

    root = staging_dir(spark, "states")
    cols = [n for n, _ in ORDERS_FILE_FIELDS]
    (
        table(spark, sf_dir, "orders")
        .select(*cols, "o_orderstatus")
        .write.partitionBy("o_orderstatus")
        .option("sep", ";")
        .option("header", True)
        .csv(f"{root}/raw")
    )
    import pyarrow.fs as pafs

    fs, raw = pafs.FileSystem.from_uri(f"{root}/raw")
    statuses = sorted(
        info.base_name.split("=", 1)[1]
        for info in fs.get_file_info(pafs.FileSelector(raw))
        if info.type == pafs.FileType.Directory and info.base_name.startswith("o_orderstatus=")
    )
    labels = [(status * 2)[:2].upper() for status in statuses]
    if len(set(labels)) < len(labels) or len(labels) > 89 or not all(x.isascii() and x.isalpha() for x in labels):
        raise ValueError(f"statuses without state folders of their own: {statuses}")
    for i, status in enumerate(statuses):
        fs.move(f"{raw}/o_orderstatus={status}", f"{raw}/{11 + i:02d}_{(status * 2)[:2].upper()}")
    table(spark, sf_dir, "nation").write.option("sep", ";").option("header", True).csv(f"{root}/raw/cnes")
    _STAGED[key] = f"{root}/raw"
    return _STAGED[key]


def stage_typed_rejects(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as ``;`` files whose price is not a number on pending orders."""
    key = (spark.sparkContext.applicationId, sf_dir, "rejects")
    if key in _STAGED:
        return _STAGED[key]
    from reglink.session import staging_dir

    root = staging_dir(spark, "rejects")
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    (
        orders.select("o_orderkey", "o_custkey", price.alias("o_totalprice"), "o_orderdate", "o_orderpriority")
        .write.option("sep", ";")
        .option("header", True)
        .csv(root)
    )
    _STAGED[key] = root
    return root


ORDERS_ARCHIVE_FIELDS = [*ORDERS_FILE_FIELDS, ("o_orderstatus", "string")]


def orders_archive_schema():
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([*orders_file_schema().fields, StructField("o_orderstatus", StringType(), True)])


def _write_zips(root: str, member_rows: int):
    """mapInPandas body: each batch of formatted lines becomes one zip archive
    of ``;`` members (header + at most ``member_rows`` lines each), written by
    the task itself to the shared folder.

    Names come from the Spark partition and the batch's place in it, so a
    retried or speculative task rewrites the same files with the same
    content instead of adding new ones.
    """
    import io
    import zipfile

    import pandas as pd

    header = ";".join(n for n, _ in ORDERS_ARCHIVE_FIELDS)

    def write(batches):
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        for batch_no, pdf in enumerate(batches):
            if pdf.empty:
                continue
            lines = pdf["line"].tolist()
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                for i, start in enumerate(range(0, len(lines), member_rows)):
                    body = "\n".join([header, *lines[start:start + member_rows]]) + "\n"
                    zf.writestr(f"part_{i:03d}.csv", body)
            name = f"{base}/orders-{int(pdf['pid'].iloc[0]):05d}-{batch_no:05d}.zip"
            with fs.open_output_stream(name) as out:
                out.write(buf.getvalue())
            yield pd.DataFrame({"archive": [name], "n_lines": [len(lines)]})

    return write


def stage_archives(spark: SparkSession, sf_dir: str, member_rows: int = 4000) -> str:
    """``orders`` as zip archives of ``;`` files, plus one corrupt and one empty archive.

    Lines are formatted by Spark (NULL as an empty field); every task packs its
    own Arrow batches into archives, so no row passes through the driver and
    the number of archives grows with the table. Archive names are fixed by
    partition and batch, so task retries overwrite rather than duplicate.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "archives", member_rows)
    if key in _STAGED:
        return _STAGED[key]
    import io
    import zipfile

    import pyarrow.fs as pafs

    from reglink.session import staging_dir

    from reglink.session import ship_package

    ship_package(spark)
    root = staging_dir(spark, "archives")
    fs, base = pafs.FileSystem.from_uri(root)
    fs.create_dir(base, recursive=True)
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in ORDERS_ARCHIVE_FIELDS]
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(";", *fields).alias("line"), F.spark_partition_id().alias("pid"))
    written = lines.mapInPandas(_write_zips(root, member_rows), "archive string, n_lines bigint")
    written.write.format("noop").mode("overwrite").save()
    # Two fixed broken inputs next to the real archives.
    with fs.open_output_stream(f"{base}/broken.zip") as out:
        out.write(b"PK\x03\x04 this is not a complete zip archive")
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w"):
        pass
    with fs.open_output_stream(f"{base}/EMPTY.ZIP") as out:
        out.write(empty.getvalue())
    with fs.open_output_stream(f"{base}/notes.txt") as out:
        out.write(b"not an archive, never listed\n")
    _STAGED[key] = root
    return root


# Orders per archive of ``stage_state_archives`` (a range of keys).
STATE_ARCHIVE_KEYS = 8192


def _write_state_zips(root: str, header: str):
    """applyInPandas body: the lines of one (state, range of keys) become one
    archive in the state's folder, one member per priority. A retry writes
    the same file again."""
    import io
    import zipfile

    import pandas as pd

    def write(key, pdf):
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        folder, block = key
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for member, lines in pdf.sort_values("line").groupby("member")["line"]:
                zf.writestr(f"{member}.csv", "\n".join([header, *lines]) + "\n")
        fs.create_dir(f"{base}/{folder}", recursive=True)
        with fs.open_output_stream(f"{base}/{folder}/orders-{block:09d}.zip") as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"n_lines": [len(pdf)]})

    return write


def stage_state_archives(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as zip archives in state folders (``11_FF/orders-0.zip``):
    one archive per status and range of ``STATE_ARCHIVE_KEYS`` keys, so their
    number grows with the table and SQL can count them. A broken and an empty
    archive lie in the folder 11_FF, a readable one outside any state folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "state_archives")
    if key in _STAGED:
        return _STAGED[key]
    import io
    import zipfile

    import pyarrow.fs as pafs

    from reglink.session import ship_package, staging_dir

    ship_package(spark)
    root = staging_dir(spark, "state-archives")
    orders = table(spark, sf_dir, "orders")
    # Statuses are few codes; folder numbers follow their order.
    folder = F.concat(F.element_at(F.create_map(*[F.lit(x) for x in ("F", "11", "O", "12", "P", "13")]), F.col("o_orderstatus")), F.lit("_"), F.repeat("o_orderstatus", 2))
    if orders.where(folder.isNull()).head(1):
        raise ValueError("a status outside F, O and P has no folder number")
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in ORDERS_FILE_FIELDS]
    lines = orders.select(
        folder.alias("folder"),
        F.floor(F.col("o_orderkey") / STATE_ARCHIVE_KEYS).alias("block"),
        F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("member"),
        F.concat_ws(";", *fields).alias("line"),
    )
    header = ";".join(n for n, _ in ORDERS_FILE_FIELDS)
    written = lines.groupBy("folder", "block").applyInPandas(_write_state_zips(root, header), "n_lines bigint")
    written.write.format("noop").mode("overwrite").save()
    empty, stray = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(empty, "w"):
        pass
    with zipfile.ZipFile(stray, "w") as zf:
        zf.writestr("p1.csv", f"{header}\n1;1;1;2000-01-01 00:00:00;x\n")
    fs, base = pafs.FileSystem.from_uri(root)
    for folder_, name, body in (("11_FF", "broken.zip", b"PK\x03\x04 this is not a complete zip archive"), ("11_FF", "EMPTY.ZIP", empty.getvalue()), ("cnes", "stray.zip", stray.getvalue())):
        fs.create_dir(f"{base}/{folder_}", recursive=True)
        with fs.open_output_stream(f"{base}/{folder_}/{name}") as out:
            out.write(body)
    _STAGED[key] = root
    return root


def stage_address_files(spark: SparkSession, sf_dir: str) -> str:
    """Every part as an address with all 34 declared fields, as ``;`` files in
    two state folders (even house numbers in 11_RO, odd ones in 35_SP)."""
    key = (spark.sparkContext.applicationId, sf_dir, "address_files")
    if key in _STAGED:
        return _STAGED[key]
    from reglink.session import staging_dir
    from reglink.sources.schemas import ADDRESS_SCHEMA

    root = staging_dir(spark, "address-files")
    adr = addresses(table(spark, sf_dir, "part"), whole=True)
    full = adr.select(*[(F.col(f.name) if f.name in adr.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ADDRESS_SCHEMA.fields])
    for folder, odd in (("11_RO", 0), ("35_SP", 1)):
        full.where(F.col("NUM_ENDERECO") % 2 == odd).write.option("sep", ";").option("header", True).csv(f"{root}/{folder}")
    _STAGED[key] = root
    return root


def stage_establishment_file(spark: SparkSession, sf_dir: str) -> str:
    """Every part as an establishment, as ``;`` files with postal codes of
    eight digits and latitudes of which a third is written with a dot."""
    key = (spark.sparkContext.applicationId, sf_dir, "establishment_file")
    if key in _STAGED:
        return _STAGED[key]
    from reglink.session import staging_dir

    root = staging_dir(spark, "establishments")
    est = dotted_establishments(table(spark, sf_dir, "part"), whole=True)
    est.withColumn("CO_CEP", F.lpad(F.col("CO_CEP").cast("string"), 8, "0")).write.option("sep", ";").option("header", True).csv(root)
    _STAGED[key] = root
    return root


def stage_monthly_dumps(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as ``;`` files in a folder per month (``period=199501``),
    beside a folder without files, one with a file still being written, one
    with a file of no bytes, and a file outside any month."""
    key = (spark.sparkContext.applicationId, sf_dir, "monthly_dumps")
    if key in _STAGED:
        return _STAGED[key]
    import pyarrow.fs as pafs

    from reglink.session import staging_dir

    root = staging_dir(spark, "dumps")
    cols = [n for n, _ in ORDERS_FILE_FIELDS]
    monthly = table(spark, sf_dir, "orders").where("o_orderdate is not null").select(*cols, F.date_format("o_orderdate", "yyyyMM").alias("period"))
    # A shuffle by month keeps the files few; months are of even size.
    monthly.repartition("period").write.partitionBy("period").option("sep", ";").option("header", True).csv(root)
    fs, base = pafs.FileSystem.from_uri(root)
    for folder, name, body in (("period=200301", None, b""), ("period=200302", "dump.csv.part", b"a;b\n1"), ("period=200303", "dump.csv", b""), ("notes", "200304.txt", b"no dump")):
        fs.create_dir(f"{base}/{folder}", recursive=True)
        if name:
            with fs.open_output_stream(f"{base}/{folder}/{name}") as out:
                out.write(body)
    _STAGED[key] = root
    return root


def index_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with the entries of a folder listing in front of their own
    content: state folders, archives, the parent link, an anchor that is
    never closed, one without ``href``, and relative, rooted, protocol-relative,
    query and fragment links."""
    p = F.col("page_id").cast("string")
    state = F.element_at(F.array(F.lit("11_RO"), F.lit("35_SP"), F.lit("33_RJ")), (F.pmod("page_id", F.lit(3)) + 1).cast("int"))
    listing = F.concat(
        F.lit('<a href="'), state, F.lit('/">'), state, F.lit("</a>\n<A class='x' HREF='17_TO//'>T&amp;O</A>\n"),
        F.lit('<a\n title="a > b" href="data/m'), p, F.lit('.zip"><b>m</b>'), p, F.lit('</a>\n<a href="../up'), p, F.lit('.zip">up\n'),
        F.lit('<a href="../">\t Parent Directory\n</a><a href="/pub/12_AC/">nested</a><a href="//mirror.example.org/x.zip">mirror</a>'),
        F.lit('<a href="?C=N;O=D">Name</a><a href="#top"> top </a><a name="here">no link</a><a href=x.ZIP>bare</a>'),
        F.lit('<a href="./a/./b/../c.zip">dots</a><a data-href="no.zip" href="last.zip">Parent Directory</a><abbr>no anchor</abbr>'),
    )
    return pages.withColumn("html", F.concat(listing, F.coalesce("html", F.lit(""))))


# Abbreviations (and one unknown word) written into the dirty street text.
DIRTY_WORDS = ("R", "av", "TV.", "Dr", "xyz")


def dirty_orders(orders: DataFrame) -> DataFrame:
    """``orders`` with a street-like text and a date written the messy ways
    registries write them: padding, tabs, symbols, abbreviations, three date
    layouts and an unparseable date on low-priority orders."""
    word = F.element_at(F.array(*[F.lit(w) for w in DIRTY_WORDS]), (F.pmod("o_custkey", F.lit(len(DIRTY_WORDS))) + 1).cast("int"))
    street = F.concat(F.lit("  "), word, F.lit(" "), F.col("o_orderpriority"), F.lit("  #"), F.col("o_orderkey").cast("string"), F.lit("\t"))
    layout = F.pmod("o_orderkey", F.lit(3))
    date = (
        F.when(layout == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(layout == 1, F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    date = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(date, F.lit("?"))).otherwise(date)
    return orders.select("o_orderkey", street.alias("street_raw"), date.alias("date_raw"))
