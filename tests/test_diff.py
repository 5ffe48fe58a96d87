"""Change-feed operators (own fixtures), plus traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footlink.functions.dates import iso_text, quoted_range_start, range_start
from footlink.operators import diff as D


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("v")).first()["v"]


@pytest.mark.parametrize("text, want", [
    ('["1999-07-04 01:30:00.5-03","1999-08-01 00:00:00-03")', dt.datetime(1999, 7, 4, 4, 30, 0, 500000)),
    ('["2031-02-28 23:59:59+0530",)', dt.datetime(2031, 2, 28, 18, 29, 59)),
    ("[2010-10-10T10:10:10+00:00,)", dt.datetime(2010, 10, 10, 10, 10, 10)),
    ("no range at all", None),
    ('(,"2010-10-10 10:10:10+00")', None),
    ("", None),
])
def test_range_start(spark, text, want):
    assert _one(spark, range_start, text) == want     # session zone is UTC


def test_iso_text_like_python(spark):
    cases = ["2016-02-29 08:15:30.123456+01", "2016-02-29 08:15:30+01", "2016-02-29 08:15:30.5+0130",
             "2016-02-29T08:15:30.000000+00", "2016-02-29", "2016-02-29 08:15:30Z"]
    for c in cases:
        want = dt.datetime.fromisoformat(c.replace("Z", "+00:00")).isoformat()
        assert _one(spark, iso_text, c) == want, c


def test_quoted_range_start(spark):
    v = _one(spark, quoted_range_start, '["2005-05-05 05:05:05.25-08",)')
    assert v == "2005-05-05T05:05:05.250000-08:00"


def _range(day, offset="+00"):
    return f'["2010-06-{day:02d} 12:00:00{offset}",)'


# Per key: newest in the middle, a tie at the top, and two spellings of one
# moment (the first seen wins).
FEED_ROWS = [
    ("north", _range(3), "n3", 0), ("south", _range(9), "s9", 1), ("north", _range(20), "n20", 2),
    ("east", _range(5, "+02"), "e-first", 3), ("south", _range(9), "s9-again", 4), ("north", _range(11), "n11", 5),
    ("east", '["2010-06-05 10:00:00+00",)', "e-same-moment", 6), ("south", _range(1), "s1", 7),
]


def test_latest_per_key(spark):
    feed = spark.createDataFrame(FEED_ROWS, "rnb_id string, sys_period string, extra string, pos long")
    out = D.latest_per_key(feed).orderBy("first_pos").collect()
    assert [(r.rnb_id, r.extra) for r in out] == [("north", "n20"), ("south", "s9"), ("east", "e-first")]
    assert out[0].sys_period == _range(20)


def test_latest_tie_first_seen_wins(spark):
    rows = [("a", '["2024-01-01 00:00:00+00",)', "first", 5), ("a", '["2024-01-01 00:00:00+00",)', "second", 9)]
    feed = spark.createDataFrame(rows, "rnb_id string, sys_period string, extra string, pos long")
    assert D.latest_per_key(feed).first().extra == "first"


def test_latest_null_time_loses_and_strict_raises(spark):
    rows = [("a", "garbage", "bad", 0), ("a", '["2024-01-01 00:00:00+00",)', "good", 1), ("b", "garbage", "only", 2)]
    feed = spark.createDataFrame(rows, "rnb_id string, sys_period string, extra string, pos long")
    got = {r.rnb_id: r.extra for r in D.latest_per_key(feed).collect()}
    assert got == {"a": "good", "b": "only"}
    with pytest.raises(Exception):
        D.latest_per_key(feed, strict=True).collect()


@pytest.mark.parametrize("active, status, gone", [
    ("0", "constructed", True), ("0", "demolished", True), ("0", None, True), ("1", "demolished", False),
    ("1", "constructionProject", True), (None, "canceledConstructionProject", True), (None, None, False),
    ("false", "constructed", False), ("", "", False),
])
def test_removal_set(spark, active, status, gone):
    df = spark.createDataFrame([("r", active, status), ("r", active, status)],
                               "rnb_id string, is_active string, status string")
    assert [r.rnb_id for r in D.removal_set(df).collect()] == (["r"] if gone else [])


def test_duplicate_guard(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "rnb_id string")
    with pytest.raises(ValueError):
        D.assert_unique(df)
    D.assert_unique(df.distinct())


def test_created_updated(spark):
    rows = [("create", '["2016-02-29 08:15:30.123456+01",)'), ("update", '["2016-02-29 08:15:30+01",)'),
            ("other", '["2016-02-29 08:15:30+01",)')]
    df = spark.createDataFrame(rows, "action string, sys_period string")
    out = D.created_updated(df).collect()
    assert (out[0].created_at, out[0].updated_at) == ("2016-02-29T08:15:30.123456+01:00", "")
    assert (out[1].created_at, out[1].updated_at) == ("", "2016-02-29T08:15:30+01:00")
    assert (out[2].created_at, out[2].updated_at) == ("", "2016-02-29T08:15:30+01:00")


def test_empty_feed_gives_empty_tables(spark, tmp_path):
    from footlink.plans import sync
    from footlink.sources.feed import FEED_COLUMNS
    p = tmp_path / "feed.csv"
    p.write_text(",".join(FEED_COLUMNS) + "\n")
    last, removed = sync.sync_from_file(spark, str(p), str(tmp_path / "out"))
    assert last.count() == 0 and removed.count() == 0


def test_csv_feed_with_quotes(spark, tmp_path):
    from footlink.plans import sync
    from footlink.sources.feed import FEED_COLUMNS
    head = ",".join(FEED_COLUMNS)
    row = lambda rid, per, ev: f'update,{rid},constructed,1,"{per}",,,,,,{ev},update'
    p = tmp_path / "feed.csv"
    p.write_text("\n".join([head,
                            row("x", '[""2024-01-02 00:00:00+01"",)', "1"),
                            row("x", '[""2024-01-03 00:00:00+01"",)', "2"),
                            row("x", '[""2024-01-03 00:00:00+01"",)', "3")]) + "\n")
    last, _ = sync.sync_from_file(spark, str(p), str(tmp_path / "out"))
    r = last.first()
    assert r.event_id == "2" and r.updated_at == "2024-01-03T00:00:00+01:00" and r.created_at is None


def test_latest_pre_aggregates_before_the_shuffle(spark):
    """A key holding a third of all rows must be combined map side: the
    plan has a partial aggregate below the exchange on the key."""
    rows = [("hot" if i % 3 == 0 else f"k{i}", f'["2024-01-{1 + i % 28:02d} 00:00:00+00",)', str(i), i)
            for i in range(300)]
    feed = spark.createDataFrame(rows, "rnb_id string, sys_period string, extra string, pos long")
    out = D.latest_per_key(feed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Exchange hashpartitioning(rnb_id" in plan
    hot = out.filter("rnb_id = 'hot'").first()
    assert hot.extra == "27"  # 2024-01-28 is the newest day among i % 3 == 0 (i = 27, 111, 195, 279: first seen)


def test_strict_raises_on_matched_but_invalid_date(spark):
    rows = [("a", '["2024-13-45 00:00:00+00",)', "bad", 0)]
    feed = spark.createDataFrame(rows, "rnb_id string, sys_period string, extra string, pos long")
    assert D.latest_per_key(feed).first().updated_at is None      # lenient: NULL
    with pytest.raises(Exception):
        D.latest_per_key(feed, strict=True).collect()


def test_feed_columns_go_by_name(spark, tmp_path):
    from footlink.sources.feed import read_feed
    p = tmp_path / "feed.csv"
    p.write_text('note,sys_period,status,action,rnb_id\nhello,"[""2010-06-01 00:00:00+00"",)",constructed,update,x\n,,,,y\n')
    rows = {r.rnb_id: r for r in read_feed(spark, str(p)).collect()}
    assert (rows["x"].action, rows["x"].status, rows["x"].note) == ("update", "constructed", "hello")
    assert rows["y"].action == "" and rows["y"].note == ""
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        read_feed(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "lines.csv").write_text('rnb_id,sys_period,note\nz,,"two\nlines"\n')
    assert read_feed(spark, str(tmp_path / "lines.csv"), multiline=True).first().note == "two\nlines"


def test_pointer_fails_loudly(spark, tmp_path):
    from footlink.sources.sinks import append_pointer, newest_pointer
    folder = str(tmp_path / "current")
    assert newest_pointer(spark, folder) is None
    append_pointer(spark, folder, path="a")
    append_pointer(spark, folder, path="b")
    assert newest_pointer(spark, folder)["path"] == "b"
    spark.createDataFrame([], "written long, path string").write.parquet(str(tmp_path / "empty"))
    with pytest.raises(RuntimeError):
        newest_pointer(spark, str(tmp_path / "empty"))


def test_distinct_on_keeps_rows_without_an_id(spark):
    from footlink.plans.jobs import _distinct_on
    df = spark.createDataFrame([("c1", None, 5), ("c2", None, 1), ("c2", "r", 2)], "cleabs string, identifiant_rnb string, v int")
    assert sorted(tuple(r) for r in _distinct_on(df, "cleabs").collect()) == [("c1", None, 5), ("c2", "r", 2)]


def test_snap_keeps_grid_values(spark):
    from footlink.functions.crs import snap
    rows = spark.range(6_000_000, 6_010_000).select((F.col("id") / 10).alias("v"))
    assert rows.where(snap(F.col("v")) != F.col("v")).count() == 0


def test_strict_dates_raise_without_a_quoted_start(spark):
    rows = spark.createDataFrame([("create", "[2024-03-01 10:00:00+00,)")], "action string, sys_period string")
    assert D.created_updated(rows).first().created_at is None
    with pytest.raises(Exception, match="no quoted start"):
        D.created_updated(rows, strict=True).collect()
