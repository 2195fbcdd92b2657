"""Type-2 and type-1 merges, watermark sync, two-part store, views."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions import fixed
from riskloom.operators import history, joins
from riskloom.operators.exposure import level_table
from riskloom.plans import staging, store, views
from riskloom.functions.scoring import enrich
from riskloom.session import shared_dir
from riskloom.sources import parts, paths
from tests.conftest import rows

KEY = ["k"]
SCHEMA = "k string, lastModified timestamp, x int"


def at(day):
    return None if day is None else dt.datetime(2024, 1, day)


def frame(spark, *data):
    return spark.createDataFrame([(k, at(d), x) for k, d, x in data], SCHEMA)


def ts(day):
    return F.lit(at(day)).cast("timestamp")


@pytest.fixture(scope="module")
def target(spark):
    base = frame(spark, ("same", 5, 1), ("newer", 5, 1), ("older", 5, 1), ("null-src", 5, 1), ("null-tgt", None, 1), ("alone", 5, 1))
    cur = base.withColumns({"validFrom": ts(6), "validTo": F.lit(None).cast("timestamp"), "currentFlag": F.lit(True)})
    old = frame(spark, ("newer", 1, 0)).withColumns({"validFrom": ts(2), "validTo": ts(6), "currentFlag": F.lit(False)})
    return cur.unionByName(old)


@pytest.fixture(scope="module")
def source(spark):
    return frame(spark, ("same", 5, 2), ("newer", 9, 2), ("newer", 8, 3), ("older", 2, 2), ("null-src", None, 2), ("null-tgt", 3, 2), ("fresh", 1, 2))


def test_scd2(target, source):
    out = history.scd2_merge(target, source, KEY, ts(20))
    current = {r.k: r for r in out.where("currentFlag").collect()}
    assert {k: r.x for k, r in current.items()} == {"same": 1, "newer": 2, "older": 1, "null-src": 1, "null-tgt": 2, "alone": 1, "fresh": 2}
    assert out.where("currentFlag").count() == 7
    closed = rows(out.where("NOT currentFlag"), "k", "x", "validTo")
    assert closed == [("newer", 0, at(6)), ("newer", 1, at(20)), ("null-tgt", 1, at(20))]
    assert current["fresh"].validFrom == at(20) and current["same"].validFrom == at(6)


def test_scd2_twice_is_once(target, source):
    once = history.scd2_merge(target, source, KEY, ts(20))
    assert rows(history.scd2_merge(once, source, KEY, ts(25))) == rows(once)


def test_scd2_by_hash(spark, target, source):
    h = F.md5(F.col("x").cast("string"))
    out = history.scd2_merge_by_hash(target.withColumn("row_hash", h), source.withColumn("row_hash", h), KEY, F.col("lastModified"),
                                     "lastModified", ("validFrom", "validTo", "currentFlag"))
    closed = out.where("NOT currentFlag AND k = 'older'").collect()
    assert [(r.x, r.validTo) for r in closed] == [(1, at(2))]
    assert closed[0].row_hash == rows(target.where("k = 'older'").select(h))[0][0]


def test_merge_changed(target, source):
    base = target.where("currentFlag").select("k", "lastModified", "x")
    out = {r.k: r.x for r in history.merge_changed(base, source, KEY, ["lastModified"], ["lastModified"]).collect()}
    assert out == {"same": 1, "newer": 2, "older": 2, "null-src": 1, "null-tgt": 1, "alone": 1, "fresh": 2}


def test_sync_matches_full(target, source):
    merged = history.scd2_merge(target, source, KEY, ts(20))
    before = history.sync_full(target, KEY)
    after = history.sync_incremental(before, merged, history.next_watermark(before), KEY)
    assert rows(after.where("currentFlag")) == rows(history.sync_full(merged, KEY))
    assert rows(history.next_watermark(after)) == [(at(20),)]
    empty = history.next_watermark(target.where("false"))
    assert rows(empty) == [(dt.datetime(1970, 1, 1),)]


def test_null_keys_never_match(spark):
    left = frame(spark, (None, 1, 1)).withColumns({"validFrom": ts(1), "validTo": F.lit(None).cast("timestamp"), "currentFlag": F.lit(True)})
    assert history.scd2_merge(left, frame(spark, (None, 2, 2)), KEY, ts(9)).count() == 2
    assert joins.insert_missing(frame(spark, (None, 1, 1)), frame(spark, (None, 2, 2)), KEY).count() == 2


def master_source(spark, *data):
    made = [
        (v, p, c, None, None, "s", [("s", "t", "3.1", f"CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:N/A:N", float(s), None, None)] if s else None,
         pub, None, None, None, mod, "d")
        for v, p, c, s, pub, mod in data
    ]
    schema = ("vendor string, product string, cveId string, cweData array<struct<cweId:string,cweDescription:string>>, "
              "capecData array<struct<capecId:string,capecDescription:string>>, vulnStatus string, cvssData array<" + fixed.CVSS_STRUCT + ">, "
              "datePublished timestamp, dateReserved timestamp, dateUpdated timestamp, datePublic timestamp, lastModified timestamp, Descriptions string")
    return staging.master_rows(spark.createDataFrame(made, schema))


D = dt.datetime
FIRST = [("v_1", "p", "CVE-1", 9.5, D(2023, 5, 1), D(2023, 6, 1)), ("v 1", "p", "CVE-1", None, D(2023, 5, 1), D(2023, 6, 1)),
         ("v2", "p", "CVE-2", 5.0, D(2022, 5, 1), D(2023, 6, 1)), ("v2", "q", "CVE-2", 5.0, D(2022, 5, 1), D(2023, 6, 1)),
         ("v3", "p", "CVE-3", 2.0, D(2021, 1, 1), D(2023, 6, 1)), ("v6", "p", "CVE-6", 3.0, None, D(2023, 6, 1))]
SECOND = [("v5", "p", "CVE-5", 8.0, None, D(2023, 7, 1)), ("v 1", "p", "CVE-1", 9.0, D(2023, 5, 1), D(2023, 7, 1)), ("v2", "p", "CVE-2", 7.5, D(2022, 7, 1), D(2023, 7, 1)),
          ("v4", "p", "CVE-4", 4.0, D(2020, 1, 1), D(2023, 7, 1)), ("v3", "p", "CVE-3", 9.9, D(2020, 2, 2), D(2023, 7, 2))]


def test_store_keeps_history(spark):
    root = shared_dir(spark, "test-store")
    store.merge_into(spark, root, master_source(spark, *FIRST), ts(1))
    store.merge_into(spark, root, master_source(spark, *SECOND), ts(2))
    store.merge_into(spark, root, master_source(spark, *SECOND), ts(3))
    whole = store.read_master(spark, root)
    assert whole.where("currentFlag").count() == 8
    assert rows(whole.where("NOT currentFlag"), "vendor", "product", "validTo") == [("v 1", "p", at(2)), ("v2", "p", at(2)), ("v3", "p", at(2))]
    first = staging.empty_master(master_source(spark, *FIRST))
    expect = first
    for data, day in ((FIRST, 1), (SECOND, 2), (SECOND, 3)):
        expect = history.scd2_merge(expect, master_source(spark, *data), fixed.RECORD_KEY, ts(day))
    assert rows(whole.select(*expect.columns)) == rows(expect)


def test_merge_leaves_other_buckets_alone(spark):
    root = shared_dir(spark, "test-store")
    store.merge_into(spark, root, master_source(spark, *FIRST, ("v9", "p", "CVE-1999-1", 1.0, D(1999, 1, 1), D(1999, 1, 1))), ts(1))
    store.merge_into(spark, root, master_source(spark, ("v9", "p", "CVE-1999-1", 2.0, D(1999, 1, 1), D(2000, 1, 1))), ts(2))
    first, second = parts.Manifest(1).run, parts.current(spark, root)
    written = {p for p, run in second.tables["current"].items() if run != first}
    assert len(written) == 1 and next(iter(written)).startswith("1999-")
    assert second.tables["closed"] == {second.run: second.run}


def test_merge_writes_only_buckets_that_change(spark):
    """Rows of a batch that change nothing cause no write; null keys, which match nothing, come in again."""
    root = shared_dir(spark, "test-store")
    store.merge_into(spark, root, master_source(spark, *FIRST), ts(1))
    store.merge_into(spark, root, master_source(spark, *FIRST), ts(2))
    first = parts.Manifest(1).run
    assert set(parts.current(spark, root).tables["current"].values()) == {first}
    third = [*FIRST[2:], ("v9", "p", "CVE-1999-1", 1.0, D(1999, 1, 1), D(1999, 1, 1)), (None, "p", "CVE-1999-1", 1.0, D(1999, 1, 1), D(1999, 1, 1))]
    expect = history.scd2_merge(staging.empty_master(master_source(spark, *FIRST)), master_source(spark, *FIRST), fixed.RECORD_KEY, ts(1))
    for day in (3, 4):
        store.merge_into(spark, root, master_source(spark, *third), ts(day))
        expect = history.scd2_merge(expect, master_source(spark, *third), fixed.RECORD_KEY, ts(day))
    assert {p for p, run in parts.current(spark, root).tables["current"].items() if run != first} <= {f"1999-{b}" for b in range(store.BUCKETS)}
    assert rows(store.read_master(spark, root).select(*expect.columns)) == rows(expect)


def test_lost_merge_changes_nothing(spark, monkeypatch):
    root = shared_dir(spark, "test-store")
    store.merge_into(spark, root, master_source(spark, *FIRST), ts(1))
    before = rows(store.read_master(spark, root))
    with monkeypatch.context() as m:
        m.setattr(parts, "commit", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.merge_into(spark, root, master_source(spark, *SECOND), ts(2))
    assert rows(store.read_master(spark, root)) == before
    store.merge_into(spark, root, master_source(spark, *SECOND), ts(2))
    assert store.read_master(spark, root).where("NOT currentFlag").count() == 3


def test_two_runs_cannot_commit_the_same_number(spark):
    root = shared_dir(spark, "test-parts")
    for _ in range(2):
        made = parts.Manifest().next()
        parts.write(spark.range(3).withColumn("part", F.lit("all")), root, made, "t")
        if parts.current(spark, root).number:
            with pytest.raises(FileExistsError):
                parts.commit(spark, root, made)
        else:
            parts.commit(spark, root, made)


def test_old_folders_go(spark):
    root = shared_dir(spark, "test-parts")
    for n in range(6):
        made = parts.current(spark, root).next()
        parts.write(spark.range(n).withColumn("part", F.lit("all")), root, made, "t")
        parts.write(spark.range(1).withColumn("part", F.lit(f"p{n}")), root, made, "kept", [])
        parts.commit(spark, root, made)
    assert len([p for r in paths.child_names(spark, f"{root}/data/table=t") for p in paths.child_names(spark, f"{root}/data/table=t/{r}") if p.startswith("part=")]) == 3
    assert parts.read(spark, root, parts.current(spark, root), "kept").count() == 6


@pytest.fixture(scope="module")
def built(spark):
    """Views refreshed incrementally, and the same state built from scratch."""
    one = history.scd2_merge(staging.empty_master(master_source(spark, *FIRST)), master_source(spark, *FIRST), fixed.RECORD_KEY, ts(1))
    two = history.scd2_merge(one, master_source(spark, *SECOND), fixed.RECORD_KEY, ts(3))
    as_of = dt.date(2023, 8, 1)
    step, full = shared_dir(spark, "test-views"), shared_dir(spark, "test-views")
    views.run(one, step, "backfill", as_of, at(2))
    # A run that is lost after any of its tables is written changes nothing, and can be repeated.
    for lost in ("lookup", "scored", "daily_vendor", "yearly_global", "exposure_index_thresholds"):
        write, seen = parts.write, parts.current(spark, step).number

        def broken(df, root, manifest, table, *a, **b):
            write(df, root, manifest, table, *a, **b)
            if table == lost:
                raise RuntimeError("lost")

        parts.write = broken
        try:
            with pytest.raises(RuntimeError, match="lost"):
                views.run(two, step, "incremental", as_of, at(4))
        finally:
            parts.write = write
        assert parts.current(spark, step).number == seen
    views.run(two, step, "incremental", as_of, at(4))
    views.run(two, step, "incremental", as_of, at(4))
    views.run(two, full, "backfill", as_of, at(4))
    return step, full


@pytest.mark.parametrize("table", ["lookup", "daily_global", "daily_vendor", "daily_product", "monthly_global", "monthly_product",
                                   "scored", "yearly_global", "yearly_vendor", "trailing_12mo_vendor", "daily_product_running",
                                   "daily_global_running", "daily_vendor_running", "daily_global_closing", "daily_product_closing",
                                   "exposure_counts", "exposure_index_thresholds", "meta"])
def test_refresh_equals_full_build(spark, built, table):
    step, full = (views.read_view(spark, root, table) for root in built)
    cols = sorted(step.columns)
    assert rows(step, *cols) == rows(full, *cols)
    assert step.count() > 0


def test_level_tables_read_the_scored_rows_once(spark, built, monkeypatch):
    """Nine tables come from one reading of the scored rows, however many there are."""
    read, seen = parts.read, []
    monkeypatch.setattr(parts, "read", lambda s, r, m, table, *a: seen.append(table) or read(s, r, m, table, *a))
    new = parts.current(spark, built[1]).next()
    views._levels(spark, built[1], new, None)
    assert seen.count("scored") == 1


def test_history_rows_are_chosen_by_flag(spark):
    """No wide rows are built to be filtered: the plan has no function over lists of rows."""
    source = master_source(spark, *SECOND)
    current = history.scd2_merge(staging.empty_master(master_source(spark, *FIRST)), master_source(spark, *FIRST), fixed.RECORD_KEY, ts(1))
    for kept in (True, False):
        plan = history.scd2_changes(current, source, fixed.RECORD_KEY, ts(3), kept=kept)._jdf.queryExecution().optimizedPlan().toString()
        assert "inline(" not in plan and "lambda r" not in plan


def test_year_without_rows_is_dropped(spark, built):
    assert rows(views.read_view(spark, built[0], "yearly_global"), "year_published") == [(2020,), (2022,), (2023,), (None,)]


def test_untouched_months_stay_and_trailing_scans_are_pruned(spark, built):
    manifest = parts.current(spark, built[0])
    assert manifest.tables["lookup"]["2022-05"] != manifest.tables["lookup"]["2023-05"] or manifest.number > 2
    plan = views.trailing_rows(spark, built[0], manifest, 1, dt.date(2023, 8, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "2023-07" in plan


def test_refresh_refuses_to_lose_rows(spark, built, monkeypatch):
    root = shared_dir(spark, "test-views")
    one = history.scd2_merge(staging.empty_master(master_source(spark, *FIRST)), master_source(spark, *FIRST), fixed.RECORD_KEY, ts(1))
    views.run(one, root, "backfill", dt.date(2023, 8, 1), at(2))
    broken = parts.current(spark, root).next()
    broken.tables["lookup"].pop("2021-01")
    parts.commit(spark, root, broken)
    with pytest.raises(ValueError, match="nothing was committed"):
        views.run(one, root, "incremental", dt.date(2023, 8, 1), at(4))


def test_refresh_carries_years_before_the_first_touched_one(spark):
    """Without changes only trailing windows and cut points are written; a change leaves the years before it
    alone; rows with nulls in their keys are refreshed too; the results equal a full build."""
    row = lambda product, record, score, year, seen: ("v5", product, record, score, D(year, 3, 1), D(2023, 9, seen))
    first = [row("p", "CVE-2001-1", 4.0, 2001, 1), row("p", "CVE-2003-1", 5.5, 2003, 1), row(None, "CVE-2004-1", 6.1, 2004, 1), row("q", "CVE-2006-1", 9.1, 2006, 1)]
    later = [row(None, "CVE-2004-1", 8.8, 2004, 2), row("r", "CVE-2005-1", 7.3, 2005, 2)]
    one = history.scd2_merge(staging.empty_master(master_source(spark, *first)), master_source(spark, *first), fixed.RECORD_KEY, ts(1))
    two = history.scd2_merge(one, master_source(spark, *later), fixed.RECORD_KEY, ts(3))
    step, full = shared_dir(spark, "test-views"), shared_dir(spark, "test-views")
    as_of = dt.date(2004, 6, 1)
    views.run(one, step, "backfill", as_of, at(2))
    before = parts.current(spark, step).tables
    views.run(one, step, "incremental", as_of, at(2))
    idle = parts.current(spark, step).tables
    assert {t for t in before if before[t] != idle[t]} == {t for t in before if t.startswith("trailing") or t == "exposure_index_thresholds"}
    views.run(two, step, "incremental", as_of, at(4))
    after = parts.current(spark, step).tables
    for table in ("daily_product_running", "daily_global_closing", "exposure_counts"):
        assert {p for p in after[table] if after[table][p] == before[table].get(p)} == {"2001", "2003"} | ({"2006"} if table == "exposure_counts" else set())
    views.run(two, full, "backfill", as_of, at(4))
    for table in after:
        a, b = (views.read_view(spark, root, table) for root in (step, full))
        assert rows(a, *sorted(a.columns)) == rows(b, *sorted(a.columns)), table


def test_moved_record_leaves_no_old_day(spark, built):
    days = [str(r[0]) for r in rows(views.read_view(spark, built[0], "daily_vendor").where("vendor = 'V2'"), "date_published")]
    assert days == ["2022-05-01", "2022-07-01"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        views.run(spark.range(1), "x", "weekly", dt.date(2024, 1, 1), at(1))


def test_instant_grain(spark):
    df = enrich(spark.createDataFrame(
        [("v", "p", "C1", D(2024, 1, 1, 5), 9.0, "Critical", "", ""), ("v", "p", "C2", D(2024, 1, 1, 6), 9.0, "Critical", "", "")],
        "vendor string, product string, cveId string, datePublished timestamp, cvssScore double, severity string, vectorString string, cvssVersion string"))
    assert level_table(df, "daily", "global").count() == 1
    assert level_table(df, "instant", "global").count() == 2
