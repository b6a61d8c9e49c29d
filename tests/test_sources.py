import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan_text, rows
from reglink.sources import registry as R
from reglink.sources.schemas import ADDRESS_SCHEMA, struct_from

ABC = struct_from([("A", "int"), ("B", "string"), ("C", "string")])


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_address_schema_has_34_fields():
    assert len(ADDRESS_SCHEMA.fields) == 34
    assert ADDRESS_SCHEMA["CEP"].dataType.simpleString() == "string"


def test_empty_and_quoted_empty_read_as_null(spark, tmp_path):
    # With default options both "" and ;; are NULL, so empty counts are 0 on CSV data.
    p = _write(tmp_path / "f" / "a.csv", 'A;B;C\n1;;""\n')
    assert rows(R.read_registry(spark, p, ABC)) == [(1, None, None)]


def test_reordered_header_fails_instead_of_shifting(spark, tmp_path):
    # A declared schema is positional; the header check refuses a reordered file.
    p = _write(tmp_path / "f" / "a.csv", "B;A;C\nx;1;y\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        R.read_registry(spark, p, ABC).collect()
    # Opting out reproduces the silent shift.
    assert rows(R.read_registry(spark, p, ABC, check_header=False)) == [(None, "1", "y")]


def test_rejected_rows_are_flagged_and_counted(spark, tmp_path):
    # Bad int, short row and long row are kept with NULLs and flagged.
    p = _write(tmp_path / "f" / "a.csv", "A;B;C\n1;x;y\nbad;x;y\n2;x\n3;x;y;z\n")
    df = R.read_registry(spark, p, ABC, keep_rejects=True)
    assert rows(R.rejected_summary(df)) == [(4, 3, 1)]


def test_all_string_and_inferred_reads_keep_identifiers(spark, tmp_path):
    # D3: inference turns a postal code into int; as_string keeps the zero.
    p = _write(tmp_path / "f" / "e.csv", "CO_CEP;N\n01310100;5\n")
    assert rows(R.read_registry(spark, p)) == [("01310100", "5")]
    inferred = R.read_registry(spark, p, infer=True, as_string=["CO_CEP"])
    assert rows(inferred) == [("01310100", 5)]


def test_load_partitioned_labels_states_and_ignores_other_folders(spark, tmp_path):
    # Only NN_XX folders are read; a downloaded dump beside them is ignored.
    raw = tmp_path / "raw"
    _write(raw / "11_RO" / "m1.csv", "A;B;C\n1;a;b\n2;c;d\n")
    _write(raw / "11_RO" / "m2.csv", "A;B;C\n3;e;f\n")
    _write(raw / "35_SP" / "m.csv", "A;B;C\n4;g;h\n")
    _write(raw / "cnes" / "dump.csv", "X;Y\n9;9\n")
    _write(raw / "RO" / "m.csv", "A;B;C\n5;i;j\n")
    df = R.load_partitioned(spark, str(raw), ABC)
    assert sorted(rows(df, "A", "UF")) == [(1, "RO"), (2, "RO"), (3, "RO"), (4, "SP")]
    counts = rows(R.source_counts(df))
    assert counts == [("RO", 3), ("SP", 1), (None, 4)]  # property: parts add up to the total
    assert rows(R.source_counts(df, total_label="ALL")) == [("ALL", 4), ("RO", 3), ("SP", 1)]


def test_load_partitioned_empty_root(spark, tmp_path):
    # No state folder raises unless allow_empty.
    (tmp_path / "raw").mkdir()
    with pytest.raises(AnalysisException):
        R.load_partitioned(spark, str(tmp_path / "raw"), ABC).collect()
    empty = R.load_partitioned(spark, str(tmp_path / "raw"), ABC, allow_empty=True)
    assert empty.count() == 0 and empty.columns == ["A", "B", "C", "UF"]


def test_union_by_name_is_strict_unless_allowed(spark):
    a = spark.createDataFrame([(1, "x")], "A int, B string")
    b = spark.createDataFrame([("y", 2)], "B string, A int")
    assert sorted(rows(R.union_sources([a, b]))) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "A int")
    with pytest.raises(AnalysisException):
        R.union_sources([a, c]).collect()
    assert sorted(rows(R.union_sources([a, c], allow_missing=True)), key=str) == [(1, "x"), (3, None)]


def test_write_partitioned_and_prune(spark, tmp_path):
    df = spark.createDataFrame([(1, "RO"), (2, "SP"), (3, "SP")], "A int, UF string")
    out = R.write_table(df, str(tmp_path / "t"), partition_by=["UF"])
    back = R.read_table(spark, out).where(F.col("UF") == "SP")
    assert sorted(rows(back, "A")) == [(2,), (3,)]
    plan = plan_text(back)
    assert "PartitionFilters: [isnotnull(UF" in plan


def test_export_distinct_and_values(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "p string, q string")
    out = R.export_distinct(df, ["p", "q"], str(tmp_path / "d"))
    assert spark.read.option("header", True).csv(out).count() == 2
    out2 = R.export_distinct_values(df, str(tmp_path / "v"))
    back = spark.read.json(out2)
    assert back.where(F.col("column_name") == "q").count() == 2  # x and NULL


def test_write_table_clusters_mixed_input(spark, tmp_path):
    import os

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("SP")).otherwise(F.lit("RO")).alias("UF"), F.col("id")
    ).repartition(7)
    out = R.write_table(df, str(tmp_path / "t"), partition_by=["UF"], files_per_partition=4)
    for uf in ("SP", "RO"):
        files = [f for f in os.listdir(f"{out}/UF={uf}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 4
    assert R.read_table(spark, out).count() == 3000


def test_inference_keeps_identifiers_as_text(spark, tmp_path):
    p = _write(tmp_path / "f" / "e.csv", "CO_CEP;N\n01310100;5\n02000000;6\n")
    df = R.read_registry(spark, p, infer=True, as_string=["CO_CEP"])
    assert sorted(rows(df)) == [("01310100", 5), ("02000000", 6)]


def test_rejected_rows_per_state(spark, tmp_path):
    raw = tmp_path / "raw"
    _write(raw / "11_RO" / "a.csv", "A;B;C\n1;a;b\nx;a;b\n")
    _write(raw / "35_SP" / "b.csv", "A;B;C\n2;a;b\n3;a\n4;a;b\n")
    df = R.load_partitioned(spark, str(raw), ABC, keep_rejects=True)
    got = sorted(rows(R.rejected_summary(df, by=["UF"])))
    assert got == [("RO", 2, 1, 1), ("SP", 3, 1, 2)]


def test_rows_of_failed_members_are_left_out(spark):
    from reglink.sources import archives as Z

    rows_ = [("z", "good", 0, "A", "ok", None), ("z", "bad", 0, "A", "ok", None), ("z", "bad", None, None, "error", "crc"), ("z", None, None, None, "ok", None)]
    df = spark.createDataFrame(rows_, "archive string, member string, line_no bigint, line string, status string, message string")
    assert [r.member for r in Z.archive_lines(df).collect()] == ["good"]
    assert Z._same_header('﻿"A";"B"', "A;B") and not Z._same_header("B;A", "A;B")
