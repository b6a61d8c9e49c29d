"""Archives to the labelled table, partitions written one by one, counts of a write."""

import os
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from reglink.sources import archives as Z
from reglink.sources import registry as R
from reglink.sources import store as S
from reglink.sources.schemas import struct_from

AB = struct_from([("A", "int"), ("B", "string")])


def _files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet") and S.MANIFEST not in d
    }


def _zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def _csv(begin, n):
    return "A;B\n" + "".join(f"{i};x{i}\n" for i in range(begin, begin + n))


# --- packing of members -------------------------------------------------------


def test_members_are_packed_by_size(spark):
    sizes = [10_000, 9_000] + [(i * 37) % 100 for i in range(500)] + [0] * 20
    listing = spark.createDataFrame([(f"a{i % 7}", f"m{i}", n) for i, n in enumerate(sizes)], "archive string, member string, size bigint")
    out = Z.pack_members(listing, 400).collect()
    assert Counter((r.archive, r.member, r.size) for r in out) == Counter((f"a{i % 7}", f"m{i}", n) for i, n in enumerate(sizes))
    load = Counter()
    for r in out:
        load[r.task] += r.size
    assert sorted(load) == list(range(len(load)))  # no task without members
    large = {r.task for r in out if r.size >= 400}
    assert len(large) == 2 and all(sum(r.task == t for r in out) == 1 for t in large)
    assert max(n for t, n in load.items() if t not in large) < 800
    assert len(load) <= 2 + sum(n for n in sizes if n < 400) // 400 + 2


def test_packing_of_nothing_and_of_one(spark):
    schema = "archive string, member string, size bigint"
    assert Z.pack_members(spark.createDataFrame([], schema), 10).count() == 0
    assert [r.task for r in Z.pack_members(spark.createDataFrame([("a", "m", 99)], schema), 10).collect()] == [0]
    with pytest.raises(ValueError):
        Z.pack_members(spark.createDataFrame([], schema), 0)


def test_a_large_member_shares_its_task_with_nothing(spark, tmp_path):
    _zip(tmp_path / "11_RO" / "a.zip", {"big.csv": _csv(0, 20_000), **{f"m{i}.csv": _csv(100_000 + i * 200, 200) for i in range(20)}})
    lines = Z.expand_archives(spark, str(tmp_path / "11_RO"), task_bytes=20_000).where(F.col("line").isNotNull())
    tasks = lines.groupBy(F.spark_partition_id().alias("t")).agg(F.collect_set("member").alias("members"), F.count(F.lit(1)).alias("n")).collect()
    assert [r.members for r in tasks if "big.csv" in r.members] == [["big.csv"]]
    small = [r.n for r in tasks if "big.csv" not in r.members]
    assert len(small) >= 2 and max(small) <= 2 * 20_000 / 10


# --- from archives to the table -----------------------------------------------


def test_archives_to_the_state_table(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _zip(raw / "11_RO" / "big.zip", {"m.csv": _csv(0, 3000)})
    _zip(raw / "11_RO" / "b.ZIP", {"m1.csv": _csv(3000, 30), "m2.csv": "B;A\nx;1\n"})  # m2: another header
    _zip(raw / "35_SP" / "c.zip", {"m.csv": _csv(5000, 10)})
    _zip(raw / "35_SP" / "none.zip", {})
    (raw / "35_SP" / "broken.zip").write_bytes(b"PK\x03\x04 broken")
    _zip(raw / "cnes" / "d.zip", {"m.csv": _csv(9000, 5)})
    tally = Z.integrate_archives(spark, str(raw), out, AB, str(tmp_path / "stage1"), rows_per_file=500)
    assert sorted(rows(tally)) == [("RO", 2, 1, 1), ("SP", 3, 2, 1)]
    table = R.read_table(spark, out)
    assert sorted(rows(table, "A", "B", "UF")) == [(i, f"x{i}", "RO") for i in range(3030)] + [(i, f"x{i}", "SP") for i in range(5000, 5010)]
    assert rows(R.source_counts(table)) == [("RO", 3030), ("SP", 10), (None, 3040)]
    # Files follow the measured sizes: ceil(3030 / 500) and one.
    files = _files(out)
    assert 2 <= sum("UF=RO" in f for f in files) <= 7 and sum("UF=SP" in f for f in files) == 1
    assert S.verify_partitions(spark, out, "UF").count() == 0

    # Ingesting one state again leaves the others' files as they are.
    again = tmp_path / "again"
    _zip(again / "35_SP" / "c.zip", {"m.csv": _csv(7000, 4)})
    Z.integrate_archives(spark, str(again), out, AB, str(tmp_path / "stage2"))
    assert {f: t for f, t in _files(out).items() if "UF=RO" in f} == {f: t for f, t in files.items() if "UF=RO" in f}
    assert rows(R.source_counts(R.read_table(spark, out))) == [("RO", 3030), ("SP", 4), (None, 3034)]
    assert S.verify_partitions(spark, out, "UF").count() == 0


def test_label_must_not_be_a_field(spark, tmp_path):
    with pytest.raises(ValueError):
        Z.integrate_archives(spark, str(tmp_path), str(tmp_path / "o"), AB, str(tmp_path / "s"), label="A")


def test_state_of_an_archive(spark):
    paths = ["file:/r/11_RO/x.zip", "file:/r/11_RO/sub/x.zip", "/r/cnes/x.zip", "s3://b/35_SP/a b.ZIP", "/11_ro/x.zip"]
    df = spark.createDataFrame([(p,) for p in paths], "archive string")
    assert [r[0] for r in df.select(Z.archive_state()).collect()] == ["RO", None, None, "SP", None]


# --- partitions of measured size ----------------------------------------------


def test_files_follow_the_measured_sizes(spark, tmp_path):
    label = F.when(F.col("id") < 6000, "SP").when(F.col("id") < 6010, "RO").when(F.col("id") < 8000, "AC")
    df = spark.range(9000).select("id", label.alias("UF"), F.lit(1).alias("label"), F.lit(2).alias("tasks")).repartition(5)
    out = str(tmp_path / "t")
    S.replace_partitions(df, out, "UF", rows_per_file=1000)
    files = Counter(f.split("/")[0] for f in _files(out))
    assert files["UF=RO"] == 1 and files["UF=SP"] <= 6 and files["UF=AC"] <= 2 and files["UF=__HIVE_DEFAULT_PARTITION__"] == 1
    back = R.read_table(spark, out)
    assert set(back.columns) == {"id", "UF", "label", "tasks"}
    assert Counter(rows(back, "UF")) == {("SP",): 6000, ("RO",): 10, ("AC",): 1990, (None,): 1000}
    assert sum(r.n_rows for r in S.manifest(spark, out).collect()) == 9000
    assert S.verify_partitions(spark, out, "UF").count() == 0


def test_copies_of_one_row_are_spread_by_a_column(spark, tmp_path):
    df = spark.range(4000).select(F.lit("same").alias("A"), F.lit("SP").alias("UF"), F.col("id").alias("no"))
    out = str(tmp_path / "t")
    S.replace_partitions(df, out, "UF", rows_per_file=1000, spread="no")
    back = R.read_table(spark, out)
    assert back.columns == ["A", "UF"] and back.count() == 4000
    sizes = [r.n_rows for r in S.manifest(spark, out).collect()]
    assert len(sizes) == 4 and max(sizes) < 1300


def test_file_names_are_cut_once_per_file(spark, tmp_path):
    out = str(tmp_path / "t")
    S.replace_partitions(spark.createDataFrame([(1, "RO"), (2, "SP"), (3, "SP"), (4, None)], "A int, UF string"), out, "UF")
    listed = S._files(spark, out, "UF")
    plan = plan_text(listed)
    # Nothing under the aggregates looks at the text of a path, row by row.
    assert "regexp" not in plan[plan.index("HashAggregate"):]
    assert sorted(rows(listed, "label", "n_rows"), key=str) == [("RO", 1), ("SP", 2), (None, 1)]
    sizes = {f: os.path.getsize(os.path.join(out, f)) for f in _files(out)}
    assert dict(rows(listed, "file", "n_bytes")) == sizes and len(sizes) == 3


def test_sizes_from_partial_counts(spark):
    counted = spark.createDataFrame([("RO", 3), ("SP", 4), ("RO", 5), (None, 2)], "UF string, n bigint")
    assert S.partition_sizes(counted, "UF", F.sum("n")) == {"RO": 8, "SP": 4, None: 2}
    assert S.partition_sizes(counted, "UF") == {"RO": 2, "SP": 1, None: 1}


def test_an_empty_frame_replaces_nothing(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "RO")], "A int, UF string")
    S.replace_partitions(df, out, "UF")
    before = _files(out)
    S.replace_partitions(df.where("A > 1"), out, "UF")
    assert _files(out) == before


def test_faults_against_the_manifest(spark, tmp_path):
    out = str(tmp_path / "t")
    S.replace_partitions(spark.createDataFrame([(1, "RO"), (2, "SP"), (3, "AC")], "A int, UF string"), out, "UF")
    # A writer that knows nothing of the manifest, a lost file, a changed one.
    spark.createDataFrame([(9,)], "A int").coalesce(1).write.parquet(f"{out}/UF=MG")
    lost = next(f for f in _files(out) if f.startswith("UF=SP"))
    os.remove(f"{out}/{lost}")
    changed = next(f for f in _files(out) if f.startswith("UF=AC"))
    spark.range(50).selectExpr("cast(id as int) as A").coalesce(1).write.parquet(str(tmp_path / "other"))
    other = next(f for f in _files(str(tmp_path / "other")))
    crc = os.path.join(out, os.path.dirname(changed), f".{os.path.basename(changed)}.crc")
    os.remove(crc)
    with open(f"{tmp_path}/other/{other}", "rb") as a, open(f"{out}/{changed}", "wb") as b:
        b.write(a.read())
    found = {(r.label, r.fault) for r in S.verify_partitions(spark, out, "UF").collect()}
    assert found == {("MG", "uncommitted"), ("SP", "missing"), ("AC", "changed")}


def test_too_many_labels_are_refused(spark):
    many = spark.range(S.MAX_LABELS + 1).select(F.col("id").cast("string").alias("UF"))
    with pytest.raises(ValueError):
        S.partition_sizes(many, "UF")
    with pytest.raises(ValueError):
        S.deal_by_size(many, "UF", {"0": 1}, rows_per_file=0)


# --- counts of a write --------------------------------------------------------


def test_counts_while_writing(spark, tmp_path):
    raw = tmp_path / "raw"
    for folder, n in (("11_RO", 3), ("35_SP", 5), ("12_AC", 0)):
        (raw / folder).mkdir(parents=True)
        (raw / folder / "a.csv").write_text(_csv(0, n))
    assert R.state_labels(spark, str(raw)) == ["AC", "RO", "SP"]
    df = R.load_partitioned(spark, str(raw), AB)
    out = str(tmp_path / "t")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("counted write", "one job")
    try:
        counts = S.write_counted(df, out, "UF", R.state_labels(spark, str(raw)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = tracker.getJobIdsForGroup("counted write")
    assert rows(counts) == [("RO", 3), ("SP", 5), (None, 8)] == rows(R.source_counts(R.read_table(spark, out)))
    assert len(jobs) <= 3  # the listing of folders (at most two) and the write
    with pytest.raises(ValueError):
        S.write_counted(df, str(tmp_path / "u"), "UF", ["RO"])
    empty = S.write_counted(df.where("A < 0"), str(tmp_path / "v"), "UF", ["RO"])
    assert rows(empty) == [(None, 0)]
