import io
import zipfile

from pyspark.sql import functions as F

from conftest import plan_text, rows
from reglink.operators import ingest as I
from reglink.sources import archives as Z
from reglink.sources.schemas import struct_from


def test_month_calendar_inclusive_truncated_and_reversed(spark):
    df = spark.createDataFrame(
        [("a", "2023-11-15", "2024-02-01"), ("b", "2024-03-31", "2024-03-01"), ("c", "2024-05-02", "2024-04-30")],
        "k string, s string, e string",
    )
    got = rows(I.month_calendar(df, "s", "e", ["k"]).orderBy("k", "period"))
    assert got == [("a", "202311"), ("a", "202312"), ("a", "202401"), ("a", "202402"), ("b", "202403")]


def test_missing_periods_against_landed_rows(spark):
    events = spark.createDataFrame(
        [("x", "2024-01-05"), ("x", "2024-04-01"), ("y", "2024-02-01"), ("y", "2024-02-20")], "k string, ts string"
    ).withColumn("ts", F.to_date("ts"))
    got = sorted(rows(I.gap_report(events, "ts", ["k"])))
    assert got == [("x", "202402"), ("x", "202403")]


INDEX = """<html><body>
<a href="?C=N;O=D">Name</a>
<a href="/pub/">Parent Directory</a>
<a href="11_RO/">11_RO/</a> <A HREF='35_SP/'><b>35_SP/</b></A>
<a href="docs/">docs/</a><a href="3550308_SAO_PAULO.zip">3550308_SAO_PAULO.zip</a>
<a href="x.ZIP">upper</a><a href="http://other.org/a.zip">abs</a><a name="top">no href</a>
<a href="R&amp;D.zip">R&amp;D &lt;2022&gt;</a>
</body></html>"""


def test_extract_links_classifies_index_page(spark):
    pages = spark.createDataFrame([(1, "https://host/census/2022/", INDEX)], "page_id int, url string, html string")
    links = I.extract_links(pages, keys=["page_id"])
    got = {r["href"]: (r["kind"], r["link_url"]) for r in links.collect()}
    assert got["11_RO/"] == ("folder", "https://host/census/2022/11_RO")
    assert got["35_SP/"][0] == "folder"
    assert got["/pub/"] == ("other", "https://host/pub")
    assert got["docs/"][0] == "other"
    assert got["3550308_SAO_PAULO.zip"] == ("archive", "https://host/census/2022/3550308_SAO_PAULO.zip")
    assert got["x.ZIP"][0] == "other"  # the listing test is case-sensitive
    assert got["http://other.org/a.zip"] == ("archive", "http://other.org/a.zip")
    assert got["R&D.zip"] == ("archive", "https://host/census/2022/R&D.zip")  # entities decoded
    assert rows(links.where(F.col("href") == "R&D.zip").select("text")) == [("R&D <2022>",)]
    assert len(got) == 9  # the anchor without href is skipped
    assert sorted(rows(I.state_folders(links))) == [("11_RO",), ("35_SP",)]
    assert rows(I.archive_links(links)).__len__() == 3


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    return buf.getvalue()


def test_archives_valid_empty_corrupt(spark, tmp_path):
    d = tmp_path / "zips"
    d.mkdir()
    (d / "a.zip").write_bytes(_zip({"m1.csv": "A;B\n1;x\n2;y\r\n", "m2.csv": "A;B\n3;z\n"}))
    (d / "EMPTY.Zip").write_bytes(_zip({}))
    (d / "bad.zip").write_bytes(b"PK\x03\x04garbage")
    (d / "readme.txt").write_text("skip me")
    expanded = Z.expand_archives(spark, str(d)).cache()
    assert rows(Z.ingest_tally(expanded)) == [(3, 2, 1)]
    failures = rows(Z.ingest_failures(expanded))
    assert len(failures) == 1 and failures[0][0].endswith("bad.zip")
    parsed = Z.parse_lines(Z.archive_lines(expanded), struct_from([("A", "int"), ("B", "string")]))
    assert sorted(rows(parsed)) == [(1, "x"), (2, "y"), (3, "z")]
    expanded.unpersist()


def test_ingest_archives_writes_once_then_parses(spark, tmp_path):
    d = tmp_path / "zips"
    d.mkdir()
    (d / "a.zip").write_bytes(_zip({"m.csv": "A;B\n1;x\n2;y\n"}))
    (d / "bad.zip").write_bytes(b"nope")
    parsed, tally = Z.ingest_archives(spark, str(d), struct_from([("A", "int"), ("B", "string")]), str(tmp_path / "exp"))
    assert sorted(rows(parsed)) == [(1, "x"), (2, "y")]
    assert rows(tally) == [(2, 1, 1)]
    assert "mapinpandas" not in plan_text(parsed).lower()


def test_large_member_streams_in_chunks(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    body = "A;B\n" + "".join(f"{i};v{i}\n" for i in range(25_000))
    (d / "big.zip").write_bytes(_zip({"big.csv": body, "small.csv": "A;B\n7;s\n"}))
    expanded = Z.expand_archives(spark, str(d), partitions=2)
    lines = Z.archive_lines(expanded).where(F.col("member") == "big.csv")
    assert rows(lines.agg(F.count("*"), F.min("line_no"), F.max("line_no"), F.count_distinct("line_no"))) == [
        (25_001, 0, 25_000, 25_001)
    ]
    parsed = Z.parse_lines(Z.archive_lines(expanded), struct_from([("A", "int"), ("B", "string")]))
    assert parsed.count() == 25_001
    assert rows(Z.ingest_tally(expanded)) == [(1, 1, 0)]


def test_archive_writer_is_idempotent_on_retry(spark, tmp_path):
    from conftest import SMALL
    from reglink.plans import fixtures as X

    root = str(tmp_path / "zips")
    (tmp_path / "zips").mkdir()
    lines = X.table(spark, SMALL, "orders").select(
        F.concat_ws(";", *[F.col(n).cast("string") for n, _ in X.ORDERS_ARCHIVE_FIELDS]).alias("line"),
        F.spark_partition_id().alias("pid"),
    )
    for _ in range(2):  # a second run stands for a retried task
        lines.mapInPandas(X._write_zips(root, 500), "archive string, n_lines bigint").write.format("noop").mode(
            "overwrite"
        ).save()
    parsed = Z.parse_lines(Z.archive_lines(Z.expand_archives(spark, root)), X.orders_archive_schema())
    assert parsed.count() == X.table(spark, SMALL, "orders").count()


def test_range_gaps_against_landed_months(spark):
    landed = spark.createDataFrame([("2024-01-10",), ("2024-03-01",), ("2023-12-31",)], "d string").select(
        F.to_date("d").alias("d")
    )
    got = sorted(rows(I.range_gaps(landed, "d", "2023-11-15", "2024-04-02")))
    assert got == [("202311",), ("202402",), ("202404",)]
    assert rows(I.range_gaps(landed, "d", "2024-05-01", "2024-04-01")) == []  # reversed range


def test_gap_report_is_one_shuffle(spark):
    from conftest import SMALL, plan_text

    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    assert plan_text(I.gap_report(orders, "o_orderdate", ["o_custkey"])).count("Exchange") == 1


def test_month_sequence_edges(spark):
    df = spark.createDataFrame(
        [("2024-01-31", "2024-03-01"), ("2024-03-05", "2024-01-01"), (None, "2024-01-01")], "s string, e string"
    )
    got = [r[0] for r in rows(df.select(I.month_sequence(F.col("s"), F.col("e")).alias("m")))]
    assert [str(d) for d in got[0]] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    assert got[1] == [] and got[2] is None


def test_resolve_url_cases(spark):
    df = spark.createDataFrame(
        [("https://h", "a.zip"), ("https://h/x/y.html?q=1#f", "b.zip"), ("https://h/x/", "/root.zip"), ("https://h/x/", "ftp://o/c.zip")],
        "page string, href string",
    )
    got = [r[0] for r in rows(df.select(I.resolve_url(F.col("page"), F.col("href"))))]
    assert got == ["https://h/a.zip", "https://h/x/b.zip", "https://h/root.zip", "ftp://o/c.zip"]


def test_list_members_reads_central_directory(spark, tmp_path):
    d = tmp_path / "z"
    d.mkdir()
    (d / "a.zip").write_bytes(_zip({"m1.csv": "x\n", "sub/m2.csv": "y\nz\n"}))
    got = sorted(rows(Z.list_members(spark, str(d)).select("member", "size", "status")), key=str)
    assert got == sorted([(None, None, "ok"), ("m1.csv", 2, "ok"), ("sub/m2.csv", 4, "ok")], key=str)


def test_archive_member_with_reordered_header_is_rejected(spark, tmp_path):
    # D8 for archives: a reordered header fails that member instead of shifting values.
    d = tmp_path / "z"
    d.mkdir()
    (d / "good.zip").write_bytes(_zip({"m.csv": "A;B\n1;x\n"}))
    (d / "swapped.zip").write_bytes(_zip({"m.csv": "B;A\ny;2\n"}))
    schema = struct_from([("A", "int"), ("B", "string")])
    parsed, tally = Z.ingest_archives(spark, str(d), schema, str(tmp_path / "exp"))
    assert rows(parsed) == [(1, "x")]
    assert rows(tally) == [(2, 1, 1)]


def test_archive_lines_keep_rejects(spark, tmp_path):
    from reglink.sources import registry as R

    d = tmp_path / "z"
    d.mkdir()
    (d / "a.zip").write_bytes(_zip({"m.csv": "A;B\n1;x\nbad;x\n2\n3;y;z\n"}))
    lines = Z.archive_lines(Z.expand_archives(spark, str(d)))
    parsed = Z.parse_lines(lines, struct_from([("A", "int"), ("B", "string")]), keep_rejects=True)
    assert rows(R.rejected_summary(parsed)) == [(4, 3, 1)]


def test_missing_periods_with_null_keys(spark):
    rows_ = [(None, "202401"), ("a", "202401"), ("a", "202402")]
    expected = spark.createDataFrame(rows_, "k string, period string")
    assert I.missing_periods(expected, expected, ["k"]).count() == 0
    left = I.missing_periods(expected, expected.where("k = 'a'"), ["k"]).collect()
    assert [tuple(r) for r in left] == [(None, "202401")]


def test_resolve_url_of_every_kind(spark):
    page = "https://h.org/a/b/c.html?q=1#f"
    want = {
        "x.zip": "https://h.org/a/b/x.zip", "../x": "https://h.org/a/x", "../../../x": "https://h.org/x", "./x/./y/../z?k=../1#..": "https://h.org/a/b/x/z?k=../1#..",
        "..": "https://h.org/a/", ".": "https://h.org/a/b/", "//o.net/p": "https://o.net/p", "/r/../s": "https://h.org/s", "?n=2": "https://h.org/a/b/c.html?n=2",
        "#g": "https://h.org/a/b/c.html?q=1#g", "": "https://h.org/a/b/c.html?q=1", "mailto:a@b": "mailto:a@b", "a..b/.c": "https://h.org/a/b/a..b/.c", "d//e": "https://h.org/a/b/d//e",
    }
    df = spark.createDataFrame([(page, h) for h in want], "page string, href string")
    got = {r.href: r.u for r in df.select("href", I.resolve_url(F.col("page"), F.col("href")).alias("u")).collect()}
    assert got == want
    bare = spark.createDataFrame([("http://h", x) for x in ("a", "../a", "?q", "/")], "page string, href string")
    assert [r[0] for r in rows(bare.select(I.resolve_url(F.col("page"), F.col("href"))))] == ["http://h/a", "http://h/a", "http://h?q", "http://h/"]


def test_anchors_are_cut_where_they_open(spark):
    html = [
        '<a href="one.zip">one<a href="11_RO/">\n RO\t</a>',  # never closed
        '<A HREF = two.zip >two</A ><a name=x>no</a><abbr href="no">x</abbr><a>none</a>',
        "<a title='a > b' data-href=\"no\" href='three.zip'><i>th</i>ree &lt;3</a> after",
        '<a href="">empty</a><a href="open.zip',  # the tag itself never ends
        None,
        "",
        "no anchors",
    ]
    df = spark.createDataFrame([(i, "http://h/d/", h) for i, h in enumerate(html)], "link_no int, url string, html string")
    got = sorted((tuple(r) for r in I.extract_links(df.withColumnRenamed("link_no", "href"), keys=["href"]).collect()), key=str)
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in got] == [
        (0, 0, "one.zip", "one", "archive"),
        (0, 1, "11_RO/", "RO", "folder"),
        (1, 0, "two.zip", "two", "archive"),
        (2, 0, "three.zip", "three <3", "archive"),
        (3, 0, "", "empty", "other"),
    ]


def test_long_pages_take_linear_time(spark):
    import time

    many = "<a href='x.zip'>unclosed " * 40_000 + "<a " + "x='" * 100_001
    df = spark.createDataFrame([("http://h/", many)], "url string, html string")
    begin = time.time()
    assert I.extract_links(df).count() == 40_000
    assert time.time() - begin < 60
