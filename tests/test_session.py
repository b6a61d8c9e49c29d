from conftest import SMALL
from reglink.session import ensure_checkpoint_dir, input_bytes, scale_conf, staging_dir


def test_scale_conf_sizes_partitions_from_input():
    tb = 100 * 1024**4
    conf = scale_conf(tb)
    assert conf["spark.sql.shuffle.partitions"] == str(tb // (128 * 1024**2))  # no clamp
    assert scale_conf(10 * 1024**3)["spark.sql.shuffle.partitions"] == "200"  # floor
    assert scale_conf(1024**4)["spark.sql.shuffle.partitions"] == str(1024**4 // (128 * 1024**2))


def test_input_bytes_reads_only_lengths(spark):
    import os

    want = sum(os.path.getsize(os.path.join(SMALL, f)) for f in os.listdir(SMALL) if f.endswith(".parquet"))
    assert input_bytes(spark, SMALL) == want


def test_checkpoint_dir_is_kept_and_staging_under_it(spark):
    root = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == root
    assert staging_dir(spark, "x").startswith(root.rstrip("/") + "/staging/x-")
