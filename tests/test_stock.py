"""K8 on buckets, and the files of K7."""

import glob
import json

import pytest

from footlink.plans import cli
from footlink.plans import sync as SY
from footlink.sources import stock as ST
from footlink.sources.sinks import export_csv, newest_pointer

HEADER = "action string, rnb_id string, status string, is_active string, sys_period string"


def _rows(spark, rows, extra=""):
    return spark.createDataFrame(rows, "rnb_id string, v string" + extra)


def _files(folder):
    return sorted(glob.glob(f"{folder}/versions/*/*/*.parquet"))


def _got(spark, folder):
    return sorted((tuple(r) for r in ST.current_stock(spark, folder).collect()), key=str)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    d = str(tmp_path / "stock")
    all_ = ST.upsert_stock(spark, d, _rows(spark, [(f"id{i}", "old") for i in range(200)]), buckets=16)
    assert all_ == list(range(16))
    before = _files(d)
    touched = ST.upsert_stock(spark, d, _rows(spark, [("id3", "new"), ("fresh", "new")]), buckets=99)
    assert 1 <= len(touched) <= 2
    new = [f for f in _files(d) if f not in before]
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in new} == set(touched)
    ptr = newest_pointer(spark, f"{d}/current")
    assert ptr["buckets"] == "16" and len(json.loads(ptr["held"])) == 16
    want = [(f"id{i}", "new" if i == 3 else "old") for i in range(200)] + [("fresh", "new")]
    assert _got(spark, d) == sorted(want, key=str)
    # the same change list again (a replayed epoch): the same stock
    ST.upsert_stock(spark, d, _rows(spark, [("id3", "new"), ("fresh", "new")]))
    assert _got(spark, d) == sorted(want, key=str)


def test_columns_nulls_and_no_change(spark, tmp_path):
    d = str(tmp_path / "stock")
    assert ST.current_stock(spark, d) is None
    assert ST.upsert_stock(spark, d, _rows(spark, []), buckets=4) == []
    assert ST.current_stock(spark, d).columns == ["rnb_id", "v"] and _got(spark, d) == []
    ST.upsert_stock(spark, d, _rows(spark, [("a", "1"), ("b", None), (None, "n")]))
    ST.upsert_stock(spark, d, _rows(spark, [("b", "2", 7)], ", level long"))      # a column the stock has not
    assert _got(spark, d) == sorted([("a", "1", None), ("b", "2", 7), (None, "n", None)], key=str)
    seen = newest_pointer(spark, f"{d}/current")["written"]
    assert ST.upsert_stock(spark, d, _rows(spark, [])) == []
    assert newest_pointer(spark, f"{d}/current")["written"] == seen
    with pytest.raises(ValueError):
        ST.upsert_stock(spark, d, _rows(spark, [("a", "1", 0)], ", _bucket int"))


def test_a_crash_before_the_pointer_leaves_the_stock(spark, tmp_path, monkeypatch):
    d = str(tmp_path / "stock")
    ST.upsert_stock(spark, d, _rows(spark, [("a", "1")]), buckets=4)

    def fail(*_, **__):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(ST, "append_pointer", fail)
        with pytest.raises(OSError):
            ST.upsert_stock(spark, d, _rows(spark, [("a", "2")]))
    assert _got(spark, d) == [("a", "1")]
    ST.upsert_stock(spark, d, _rows(spark, [("a", "2")]))
    assert _got(spark, d) == [("a", "2")]


def _feed(spark, path, rows):
    export_csv(spark.createDataFrame(rows, HEADER), path)


def _period(day):
    return f'["2024-01-{day:02d} 10:00:00+00",)'


def test_upsert_job_and_csv_files(spark, tmp_path):
    one, two, out, stock = (str(tmp_path / n) for n in ("one", "two", "out", "stock"))
    _feed(spark, one, [("create", "A", "constructed", "1", _period(1)), ("update", "A", "demolished", "1", _period(2)),
                       ("create", "B", "constructed", "1", _period(1)), ("update", "C", "constructed", "0", _period(3))])
    _feed(spark, two, [("update", "B", "notUsable", "1", _period(9))])
    for feed in (one, two, two):
        cli.main(["upsert", "--feed", feed, "--out", stock, "--buckets", "8"], spark=spark)
    got = {r.rnb_id: r.status for r in ST.current_stock(spark, stock).collect()}
    assert got == {"A": "demolished", "B": "notUsable", "C": "constructed"}

    cli.main(["sync", "--feed", one, "--out", out, "--csv"], spark=spark)
    folder = SY.current_csv(spark, out)
    read = lambda n: spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{n}.csv")
    last = read("rnb_last_changes")
    assert last.columns == [c.split()[0] for c in HEADER.split(", ")]        # the feed's format
    assert {(r.rnb_id, r.status, r.sys_period) for r in last.collect()} == {
        ("A", "demolished", _period(2)), ("B", "constructed", _period(1)), ("C", "constructed", _period(3))}
    assert [r.rnb_id for r in read("link_remove").collect()] == ["C"]
    assert {r.rnb_id for r in read("link_calculate").collect()} == {"A", "B"}
    cli.main(["sync", "--feed", two, "--out", out], spark=spark)
    assert not glob.glob(f"{SY.current_csv(spark, out)}*")
