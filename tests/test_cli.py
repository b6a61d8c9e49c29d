"""The command-line jobs end to end on registry-shaped files."""

from pyspark.sql import functions as F

from conftest import SMALL, rows
from reglink import cli
from reglink.operators import ingest as I
from reglink.plans import catalog
from reglink.plans import fixtures as X
from reglink.sources.schemas import ADDRESS_SCHEMA


def _address_files(spark, part, raw: str) -> None:
    adr = X.addresses(part)
    full = adr.select(
        *[
            (F.col(f.name) if f.name in adr.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ADDRESS_SCHEMA.fields
        ]
    )
    for folder, cond in (("11_RO", F.col("NUM_ENDERECO") % 2 == 0), ("35_SP", F.col("NUM_ENDERECO") % 2 == 1)):
        full.where(cond).write.option("sep", ";").option("header", True).csv(f"{raw}/{folder}")


def test_integrate_link_profile_months(spark, tmp_path):
    part = X.table(spark, SMALL, "part")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _address_files(spark, part, raw)
    est = str(tmp_path / "cnes")
    X.establishments(part).write.option("sep", ";").option("header", True).csv(est)

    cli.main(["integrate", raw, out, "--rejects"], spark=spark)
    counts = dict(rows(spark.read.parquet(f"{out}/source_counts")))
    assert counts["TOTAL"] == counts["RO"] + counts["SP"] == part.where("p_partkey % 2 = 1").count()
    rejects = {r["UF"]: (r["n_rows"], r["n_rejected"]) for r in spark.read.parquet(f"{out}/rejected_rows").collect()}
    assert rejects == {"RO": (counts["RO"], 0), "SP": (counts["SP"], 0)}

    cli.main(["link", f"{out}/addresses", est, f"{out}/link", "--links"], spark=spark)
    got = {r["rule"]: r.asDict() for r in spark.read.parquet(f"{out}/link/match_report").collect()}
    want = {r["rule"]: r.asDict() for r in catalog.QUERIES["match_report"](spark, SMALL).collect()}
    assert got == want
    assert spark.read.parquet(f"{out}/link/link_name").count() == X.establishments(part).count()

    cli.main(["profile", f"{out}/addresses", f"{out}/profile", "--top", "5"], spark=spark)
    assert spark.read.parquet(f"{out}/profile/fill_comparison").count() == len(ADDRESS_SCHEMA.fields) + 1

    orders = f"{SMALL}/orders.parquet"
    cli.main(["months", orders, "o_orderdate", f"{out}/months", "--key", "o_custkey"], spark=spark)
    direct = I.gap_report(spark.read.parquet(orders), "o_orderdate", ["o_custkey"])
    assert spark.read.parquet(f"{out}/months/missing_periods").exceptAll(direct).count() == 0
    assert spark.read.parquet(f"{out}/months/missing_periods").count() == direct.count()


def test_archives_and_links(spark, tmp_path):
    import zipfile

    header = ";".join(f.name for f in ADDRESS_SCHEMA.fields)
    for folder, n in (("11_RO", 3), ("35_SP", 2)):
        (tmp_path / "raw" / folder).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "raw" / folder / "a.zip", "w") as z:
            z.writestr("a.csv", "\n".join([header, *[f"{i}" + ";" * (len(ADDRESS_SCHEMA.fields) - 1) for i in range(n)]]) + "\n")
    out = str(tmp_path / "out")
    cli.main(["archives", str(tmp_path / "raw"), out], spark=spark)
    assert sorted(rows(spark.read.parquet(f"{out}/state_counts"))) == [("RO", 3, 1), ("SP", 2, 1)]
    assert sorted(rows(spark.read.parquet(f"{out}/archive_tally"))) == [("RO", 1, 1, 0), ("SP", 1, 1, 0)]
    assert spark.read.parquet(f"{out}/manifest_faults").count() == 0
    table = spark.read.parquet(f"{out}/addresses")
    assert table.columns == [*ADDRESS_SCHEMA.fieldNames(), "UF"] and table.count() == 5

    pages = [("http://h/d/index.html", '<a href="11_RO/">RO</a> <a href="x.zip">x</a> <a href="../">Parent Directory</a>')]
    spark.createDataFrame(pages, "url string, html string").write.parquet(str(tmp_path / "pages"))
    cli.main(["links", str(tmp_path / "pages"), out], spark=spark)
    assert rows(spark.read.parquet(f"{out}/state_folders")) == [("11_RO",)]
    assert rows(spark.read.parquet(f"{out}/archive_links")) == [("http://h/d/x.zip",)]


def test_landings(spark, tmp_path):
    for month in ("202401", "202403"):
        (tmp_path / "raw" / f"BASE_{month}").mkdir(parents=True)
        (tmp_path / "raw" / f"BASE_{month}" / "a.csv").write_text("x")
    cli.main(["landings", str(tmp_path / "raw"), str(tmp_path / "out"), "--start", "2024-01", "--end", "2024-03"], spark=spark)
    assert rows(spark.read.parquet(str(tmp_path / "out" / "missing_landings"))) == [("202402",)]
