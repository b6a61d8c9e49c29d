"""Command-line entry for the registry jobs.

    python -m reglink.cli integrate RAW_DIR OUT [--rejects]
    python -m reglink.cli archives RAW_DIR OUT
    python -m reglink.cli links PAGES OUT
    python -m reglink.cli landings ROOT OUT --start 2024-01 --end 2024-12
    python -m reglink.cli profile TABLE OUT [--csv] [--sep ;] [--top 100]
    python -m reglink.cli link ADDRESSES ESTABLISHMENTS OUT [--sep ;] [--all-species] [--links] [--all-links]
    python -m reglink.cli months PATH TS_COLUMN OUT [--key COL ... | --start D --end D]

Every result is written as a table under OUT (Parquet, plus a small CSV copy
of each report for reading by eye); nothing is collected to the driver
beyond the one-row counts it prints. Master and resources come from
``spark-submit``; ``spark.checkpoint.dir`` is read when set.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.functions.expr import string_columns
from reglink.operators import ingest as I
from reglink.operators import landing as LD
from reglink.operators import link as L
from reglink.operators import profile as P
from reglink.session import build_session, staging_dir, tune_for_input
from reglink.sources import archives as Z
from reglink.sources import registry as R
from reglink.sources import store as S
from reglink.sources.schemas import ADDRESS_SCHEMA, ESTABLISHMENT_ID


def _save(df: DataFrame, out: str, name: str, csv_copy: bool = True) -> DataFrame:
    """Write a report once; the CSV copy and the returned frame read it back."""
    df.write.mode("overwrite").parquet(f"{out}/{name}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{out}/{name}")
    if csv_copy:
        # Only for reports bounded by the schema, the rules or the sources (one
        # row per column, rule or state, or a top-k): one CSV file each.
        written.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/{name}_csv")
    return written


def _read_any(spark: SparkSession, path: str, csv: bool, sep: str) -> DataFrame:
    if csv:
        return R.read_registry(spark, path, sep=sep)
    return spark.read.parquet(path)


def integrate(spark: SparkSession, args) -> None:
    """All state folders -> one Parquet table partitioned by state, then counts.

    With ``--rejects`` the raw line of every short, long or mistyped row is
    kept in ``_corrupt_record`` and a per-state reject report is written; the
    report is computed from the written table, so the files are scanned once.
    """
    df = R.load_partitioned(spark, args.raw_dir, ADDRESS_SCHEMA, sep=args.sep, keep_rejects=args.rejects)
    # The counts are metrics of the write.
    counts = S.write_counted(df, f"{args.out}/addresses", "UF", R.state_labels(spark, args.raw_dir))
    _save(counts.fillna("TOTAL", ["UF"]), args.out, "source_counts")
    if args.rejects:
        written = R.read_table(spark, f"{args.out}/addresses")
        _save(R.rejected_summary(written, by=["UF"]), args.out, "rejected_rows")


def archives(spark: SparkSession, args) -> None:
    """State folders of archives -> the table partitioned by state; the states
    found replace theirs. Writes the tally of archives per state, the rows per
    state by the manifest, and the files that differ from it."""
    out = f"{args.out}/addresses"
    tally = Z.integrate_archives(spark, args.raw_dir, out, ADDRESS_SCHEMA, staging_dir(spark, "archives"), sep=args.sep, encoding=args.encoding)
    _save(tally, args.out, "archive_tally")
    counts = S.manifest(spark, out).groupBy(F.col("label").alias("UF")).agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))
    _save(counts, args.out, "state_counts")
    _save(S.verify_partitions(spark, out, "UF"), args.out, "manifest_faults", csv_copy=False)


def links(spark: SparkSession, args) -> None:
    """Links of saved index pages (columns url, html): all of them, the state
    folders and the archives to fetch."""
    found = _save(I.extract_links(spark.read.parquet(args.pages)), args.out, "links", csv_copy=False)
    _save(I.state_folders(found), args.out, "state_folders")
    _save(I.archive_links(found), args.out, "archive_links", csv_copy=False)


def profile(spark: SparkSession, args) -> None:
    """Fill rates (basic, strict, losses), blanks, top values, distinct values
    of the data columns (a kept ``_corrupt_record`` column is not profiled)."""
    df = _read_any(spark, args.table, args.csv, args.sep).drop(R.CORRUPT_COLUMN)
    comparison = _save(P.fill_comparison(df), args.out, "fill_comparison")
    _save(P.fill_losses(comparison), args.out, "fill_losses")
    if string_columns(df):
        _save(P.empty_profile(df), args.out, "empty_profile")
        R.export_distinct_values(df, f"{args.out}/distinct_values")
    _save(P.value_frequencies(df, k=args.top), args.out, "value_frequencies", csv_copy=False)


def link(spark: SparkSession, args) -> None:
    """Coverage of every linkage rule in one job, data-quality reports of the
    establishment file, and (``--links``) the per-establishment links."""
    addresses = spark.read.parquet(args.addresses)
    if not args.all_species:
        addresses = L.health_addresses(addresses)
    # The delimited file feeds every report below: parse it once into a
    # Parquet table under OUT (cuts the lineage; later reads prune columns).
    raw = R.read_registry(spark, args.establishments, sep=args.sep, encoding=args.encoding)
    establishments = R.read_table(spark, R.write_table(raw, f"{args.out}/establishments"))
    rules = L.registry_rules(normalize_number=args.normalize_number, coordinate_digits=args.coordinate_digits, clean=args.clean)
    _save(L.match_report(establishments, addresses, rules), args.out, "match_report")
    _save(P.malformed_summary(establishments, "NU_LATITUDE", "NU_LONGITUDE"), args.out, "malformed_coordinates")
    _save(P.duplicate_groups(establishments, ["NO_FANTASIA", "CO_CEP"]), args.out, "duplicate_groups")
    _save(P.distinct_count(establishments, [ESTABLISHMENT_ID]), args.out, "distinct_units")
    if args.all_links:
        # Every establishment under every rule, by one join; a folder per rule.
        linked = L.link_all(establishments, addresses, rules, ESTABLISHMENT_ID, "COD_UNICO_ENDERECO")
        linked.write.mode("overwrite").partitionBy("rule").parquet(f"{args.out}/links")
    if args.links:
        # One table per rule: every establishment with its partner count and
        # smallest partner id (a join per rule, so only on request).
        for rule in rules:
            linked = L.link(establishments, addresses, rule, right_id="COD_UNICO_ENDERECO")
            linked.write.mode("overwrite").parquet(f"{args.out}/link_{rule.name}")


def landings(spark: SparkSession, args) -> None:
    """Monthly folders under ROOT -> the ledger under OUT brought up to date,
    and the months of the range that have not landed whole."""
    LD.update_ledger(spark, args.root, f"{args.out}/ledger", args.start, args.end)
    _save(LD.missing_landings(spark, f"{args.out}/ledger", args.start, args.end), args.out, "missing_landings")


def months(spark: SparkSession, args) -> None:
    """Months without rows inside each group's own first..last range."""
    df = spark.read.parquet(args.path)
    if args.start or args.end:
        if not (args.start and args.end) or args.key:
            raise SystemExit("--start and --end go together and exclude --key")
        gaps = I.range_gaps(df, args.ts_column, args.start, args.end)
    else:
        gaps = I.gap_report(df, args.ts_column, args.key or [])
    # Grows with groups x months: Parquet only (a one-file copy would be one task).
    _save(gaps, args.out, "missing_periods", csv_copy=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reglink")
    sub = p.add_subparsers(dest="command", required=True)

    a = sub.add_parser("integrate", help="state folders of ; files -> partitioned Parquet + counts")
    a.add_argument("raw_dir")
    a.add_argument("out")
    a.add_argument("--sep", default=";")
    a.add_argument("--rejects", action="store_true", help="keep and report rows that do not fit the schema")
    a.set_defaults(run=integrate)

    e = sub.add_parser("archives", help="state folders of zip archives -> partitioned Parquet + tally")
    e.add_argument("raw_dir")
    e.add_argument("out")
    e.add_argument("--sep", default=";")
    e.add_argument("--encoding", default="utf-8")
    e.set_defaults(run=archives)

    f = sub.add_parser("links", help="links of saved index pages")
    f.add_argument("pages")
    f.add_argument("out")
    f.set_defaults(run=links)

    b = sub.add_parser("profile", help="column quality profiles of a table")
    b.add_argument("table")
    b.add_argument("out")
    b.add_argument("--csv", action="store_true", help="the table is delimited text (read as strings)")
    b.add_argument("--sep", default=";")
    b.add_argument("--top", type=int, default=100)
    b.set_defaults(run=profile)

    c = sub.add_parser("link", help="link establishments (delimited) to addresses (Parquet)")
    c.add_argument("addresses")
    c.add_argument("establishments")
    c.add_argument("out")
    c.add_argument("--sep", default=";")
    c.add_argument("--encoding", default=None)
    c.add_argument("--all-species", action="store_true", help="do not keep health units only")
    c.add_argument("--normalize-number", action="store_true")
    c.add_argument("--coordinate-digits", type=int, default=None)
    c.add_argument("--clean", action="store_true", help="compare names and streets after cleaning")
    c.add_argument("--links", action="store_true", help="also write one link table per rule")
    c.add_argument("--all-links", action="store_true", help="also write the links under all rules as one table")
    c.set_defaults(run=link)

    g = sub.add_parser("landings", help="months whose folder has not landed whole")
    g.add_argument("root")
    g.add_argument("out")
    g.add_argument("--start", required=True, help="first month (ISO)")
    g.add_argument("--end", required=True, help="last month (ISO)")
    g.set_defaults(run=landings)

    d = sub.add_parser("months", help="missing months per group")
    d.add_argument("path")
    d.add_argument("ts_column")
    d.add_argument("out")
    d.add_argument("--key", action="append", help="groups, each checked over its own first..last range")
    d.add_argument("--start", help="first expected day (ISO), with --end: one fixed range")
    d.add_argument("--end", help="last expected day (ISO)")
    d.set_defaults(run=months)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    session = spark
    if session is None:
        session = build_session(app_name=f"reglink-{args.command}")
        # Shuffle partitions and splits by the measured size of the input.
        source = next((getattr(args, a) for a in ("raw_dir", "table", "addresses", "pages", "path") if hasattr(args, a)), None)
        if source:
            tune_for_input(session, source)
    args.run(session, args)


if __name__ == "__main__":
    main(sys.argv[1:])
