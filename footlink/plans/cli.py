"""Command line: ``python -m footlink <job> ...`` (or through
``spark-submit``). Each job reads real tables, runs on the session the
cluster provides and writes Parquet tables under ``--out``.

Jobs: ``sync`` (D8, with ``--csv`` K7), ``upsert`` (K8), ``work-tables`` (W1-W4), ``match-registry`` (O1),
``match-topo`` (O2), ``drop-destroyed`` (O3).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from footlink.operators import diff as D
from footlink.operators import localise as LO
from footlink.operators import worktables as W
from footlink.plans import jobs as JB
from footlink.plans import pools as PL
from footlink.plans import sync as SY
from footlink.session import SCALE_CONF, ensure_checkpoint_dir, ship_package
from footlink.sources import feed as FD
from footlink.sources.sinks import replace_table
from footlink.sources.stock import BUCKETS, upsert_stock
from footlink.sources.territories import territories
from footlink.streaming.landing import STOCK_DROP


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Parquet folders as they are; CSV through the typed readers."""
    if not path.endswith(".csv"):
        return spark.read.parquet(path)
    if kind == "links":
        return FD.read_link_table(spark, path)
    if kind == "buildings":
        return FD.typed_buildings(FD.read_building_staging(spark, path))
    raise ValueError(kind)


def main(argv=None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="footlink")
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("sync", help="D8: feed → rnb_last_changes + rnb_to_remove")
    s.add_argument("--feed", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--strict", action="store_true")
    s.add_argument("--run-date")
    s.add_argument("--csv", action="store_true", help="also write the three CSV files of the run")
    u = sub.add_parser("upsert", help="K8: latest rows of a feed into the bucketed stock under --out")
    u.add_argument("--feed", required=True)
    u.add_argument("--out", required=True)
    u.add_argument("--strict", action="store_true")
    u.add_argument("--buckets", type=int, default=BUCKETS, help="of a new stock")
    w = sub.add_parser("work-tables", help="W1-W4 from the published diff tables")
    w.add_argument("--diff", required=True, help="--out folder of a sync run")
    w.add_argument("--links", required=True)
    w.add_argument("--out", required=True)
    for name in ("match-registry", "match-topo", "drop-destroyed"):
        m = sub.add_parser(name)
        m.add_argument("--links", required=True)
        m.add_argument("--buildings", required=True)
        m.add_argument("--as-of", default=dt.date.today().isoformat())
        m.add_argument("--out", required=True)
        if name == "match-topo":
            m.add_argument("--fridays-only", action="store_true")
        if name == "drop-destroyed":
            m.add_argument("--thursdays-only", action="store_true")
        else:
            m.add_argument("--compat-delete", action="store_true")
            m.add_argument("--compat-buffer", action="store_true",
                           help="use the source's 32-gon point buffers for the 100 m candidates")
    a = ap.parse_args(argv)

    if spark is None:
        b = SparkSession.builder.appName(f"footlink-{a.job}")
        for k, v in SCALE_CONF.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    out = a.out.rstrip("/")

    if a.job == "sync":
        SY.sync_from_file(spark, a.feed, out, strict=a.strict, run_date=a.run_date, csv=a.csv)
        return
    if a.job == "upsert":
        latest = D.latest_per_key(FD.read_feed(spark, a.feed), strict=a.strict)
        upsert_stock(spark, out, latest.drop(*STOCK_DROP), buckets=a.buckets)
        return
    if a.job == "work-tables":
        last, removed = SY.current_tables(spark, a.diff)
        links = PL.link_envelopes(_read(spark, a.links, "links"))
        terr = territories(spark)
        replace_table(W.deactivated_to_delete(removed, links), f"{out}/delete_deactivation", blanks=False)
        replace_table(W.demolished_to_delete(last, links), f"{out}/delete_demolished", blanks=False)
        replace_table(LO.changed_to_update(last, links, terr), f"{out}/update_moissonnage", blanks=False)
        replace_table(LO.new_to_insert(last, links, terr), f"{out}/insert_moissonnage", blanks=False)
        return
    links = _read(spark, a.links, "links")
    buildings = _read(spark, a.buildings, "buildings")
    if a.job == "drop-destroyed":
        res = JB.job_topo_destroyed(links, buildings, a.as_of, enforce_weekday=a.thursdays_only)
        if res is not None:
            replace_table(res, f"{out}/update_bdtopo_suppr", blanks=False)
        return
    R = PL.registry_pool(links)
    B = PL.topo_pool(buildings)
    link_lists = links.select("cleabs", "liens_vers_batiment")
    if a.job == "match-registry":
        res, casc = JB.job_registry_change(R, link_lists, B, a.as_of, compat_delete=a.compat_delete,
                                           compat_buffer=a.compat_buffer)
        name = "update_batiment_rnb_creation"
    else:
        res, casc = JB.job_topo_created(R, link_lists, B, a.as_of, enforce_weekday=a.fridays_only,
                                        compat_delete=a.compat_delete, compat_buffer=a.compat_buffer)
        name = "update_bdtopo_creation"
    if res is None:
        return
    replace_table(res, f"{out}/{name}", blanks=False)
    replace_table(casc.claims, f"{out}/claims", blanks=False)
