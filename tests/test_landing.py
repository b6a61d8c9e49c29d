"""The ledger of monthly dumps."""

import os

from conftest import rows
from reglink.operators import landing as LD


def _file(root, folder, name="a.csv", body="x"):
    (root / folder).mkdir(parents=True, exist_ok=True)
    (root / folder / name).write_text(body)


def test_months():
    assert LD.months("2023-11-30", "2024-02-01") == ["202311", "202312", "202401", "202402"]
    assert LD.months("2024-02", "2024-01") == []


def test_only_whole_folders_have_landed(spark, tmp_path):
    root = tmp_path / "dumps_202001"  # digits in the root's name are no month
    _file(root, "BASE_202401")
    _file(root, "BASE_202402", "a.csv.part")
    _file(root, "BASE_202403", "a.csv", "")
    (root / "BASE_202404").mkdir()
    _file(root, "BASE_202405/inner", "b.csv")
    _file(root, "BASE_202406")
    _file(root, "BASE_202406", "b.tmp")
    _file(root, "BASE_2024071")  # a longer number
    _file(root, "BASE_202413")  # no such month
    _file(root, "other", "202408.csv")  # the month has to be a folder's
    ledger = str(tmp_path / "ledger")
    assert LD.update_ledger(spark, str(root), ledger, "2024-01", "2024-09") == LD.months("2024-01", "2024-09")
    got = {r.period: (r.n_files, r.n_bytes, r.n_partial) for r in LD.read_ledger(spark, ledger).collect()}
    assert got == {"202401": (1, 1, 0), "202402": (1, 1, 1), "202405": (1, 1, 0), "202406": (2, 2, 1)}
    missing = ["202402", "202403", "202404", "202406", "202407", "202408", "202409"]
    assert sorted(r[0] for r in rows(LD.missing_landings(spark, ledger, "2024-01", "2024-09"))) == missing


def test_a_later_run_lists_the_pending_months_only(spark, tmp_path):
    root, ledger = tmp_path / "d", str(tmp_path / "ledger")
    _file(root, "m202401")
    _file(root, "m202402", "a.csv.part")
    LD.update_ledger(spark, str(root), ledger, "2024-01", "2024-02")
    # The download ends, a month arrives, and a landed one gains a file.
    os.rename(root / "m202402" / "a.csv.part", root / "m202402" / "a.csv")
    _file(root, "m202403")
    _file(root, "m202401", "late.csv.part")
    assert LD.update_ledger(spark, str(root), ledger, "2024-01", "2024-04") == ["202402", "202403", "202404"]
    assert rows(LD.missing_landings(spark, ledger, "2024-01", "2024-04")) == [("202404",)]
    assert LD.update_ledger(spark, str(root), ledger, "2024-01", "2024-03") == []


def test_no_files_at_all(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    (tmp_path / "d").mkdir()
    LD.update_ledger(spark, str(tmp_path / "d"), ledger, "2024-01", "2024-02")
    assert len(rows(LD.missing_landings(spark, ledger, "2024-01", "2024-02"))) == 2
    assert LD.list_landings(spark, str(tmp_path / "d"), []).count() == 0
