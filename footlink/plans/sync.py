"""The diff sync job — scan the feed, keep the newest row per id,
derive the removal set and the dated last-changes table, write both.

The two outputs are written under a run folder and then published with a
one-row pointer table, so readers never see one table of a run without
the other (the source commits both in one transaction).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from footlink.operators import diff as D
from footlink.session import cut_lineage
from footlink.sources import sinks
from footlink.sources.feed import read_feed

OUTPUT_DROP = ["pos", "first_pos"]


def handle_diff(feed: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """D2 → (D7, D4). The latest rows are materialised once (they feed
    both outputs). An empty feed gives two empty tables (the source fails
    on it; we do not)."""
    latest = cut_lineage(D.latest_per_key(feed, strict=strict))
    if strict:
        D.assert_unique(latest)
    removed = D.removal_set(latest)
    last_changes = D.created_updated(latest, strict=strict)
    return last_changes, removed


def publish(spark: SparkSession, out_dir: str, last_changes: DataFrame, removed: DataFrame,
            run_date: str | None = None, run_id: str | None = None, csv_columns: list[str] | None = None) -> str:
    """Both tables under a run folder, with ``csv_columns`` (the feed's) also the
    files of K7, then the pointer row."""
    run_date = run_date or dt.date.today().isoformat()
    run_id = run_id or uuid.uuid4().hex
    base = f"{out_dir.rstrip('/')}/runs/{run_id}"
    comment = f"Ne pas supprimer - {run_date}"
    sinks.replace_table(last_changes.drop(*[c for c in OUTPUT_DROP if c in last_changes.columns]),
                        f"{base}/rnb_last_changes")
    sinks.replace_table(removed, f"{base}/rnb_to_remove")
    if csv_columns is not None:
        written = [spark.read.parquet(f"{base}/{t}") for t in ("rnb_last_changes", "rnb_to_remove")]
        export_files(written[0].select(*csv_columns), written[1], f"{base}/csv")
    sinks.append_pointer(spark, f"{out_dir.rstrip('/')}/current", run_id=run_id, run_date=run_date, comment=comment)
    return base


def _current_run(spark: SparkSession, out_dir: str) -> str:
    pointer = sinks.newest_pointer(spark, f"{out_dir.rstrip('/')}/current")
    if pointer is None:
        raise RuntimeError(f"{out_dir}: nothing has been published")
    return f"{out_dir.rstrip('/')}/runs/{pointer['run_id']}"


def current_tables(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """Read the published pair of tables."""
    base = _current_run(spark, out_dir)
    return spark.read.parquet(f"{base}/rnb_last_changes"), spark.read.parquet(f"{base}/rnb_to_remove")


def export_files(last_changes: DataFrame, removed: DataFrame, folder: str) -> None:
    """K7: the three files handed on. ``rnb_last_changes.csv`` has the latest
    row per id, ``link_remove.csv`` the ids whose links go (D4) and
    ``link_calculate.csv`` those to match again (D6), one column ``rnb_id``. Each is
    a folder of CSV parts with a header, written in parallel."""
    folder = folder.rstrip("/")
    sinks.export_csv(last_changes, f"{folder}/rnb_last_changes.csv")
    sinks.export_csv(removed.select("rnb_id"), f"{folder}/link_remove.csv")
    sinks.export_csv(D.recalc_set(last_changes, removed).select("rnb_id"), f"{folder}/link_calculate.csv")


def sync_from_file(spark: SparkSession, path: str, out_dir: str, strict: bool = False,
                   run_date: str | None = None, csv: bool = False) -> tuple[DataFrame, DataFrame]:
    """The whole job for a feed file (or folder) at ``path``; with ``csv`` the
    run folder also has the files of K7, in the feed's columns."""
    feed = read_feed(spark, path)
    last_changes, removed = handle_diff(feed, strict)
    columns = [c for c in feed.columns if c != "pos"]
    publish(spark, out_dir, last_changes, removed, run_date, csv_columns=columns if csv else None)
    return current_tables(spark, out_dir)


def current_csv(spark: SparkSession, out_dir: str) -> str:
    """Folder of the CSV files of the published run."""
    return f"{_current_run(spark, out_dir)}/csv"
