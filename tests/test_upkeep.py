"""Stored sketches, carried totals, watched rows, watermarks, empty archives."""

import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import quality, running, thresholds
from riskloom.plans import staging, views
from riskloom.operators import history
from riskloom.functions import fixed
from riskloom.session import shared_dir
from riskloom.sources import records
from riskloom.sources.staged import stored
from tests.conftest import rows
from tests.test_history import FIRST, at, master_source, ts

EMPTY = "level string, part int, exposure_index double"


def indexes(spark, draw, n):
    made = [(f"L{draw.randrange(3)}", draw.choice([None, 1999, 2000, 2001]), draw.choice([None, float(draw.randrange(50)), draw.random() * 10**6])) for _ in range(n)]
    return spark.createDataFrame(made, EMPTY)


def test_sketches_stay_within_one_percent_of_rank(spark):
    df = stored(indexes(spark, random.Random(1), 40_000).repartition(7), "index")
    stats = thresholds.sketched_percentiles(thresholds.sketches(df, "part"))
    exact = {r.level: r for r in thresholds.percentiles(thresholds.value_counts(df)).collect()}
    for r in stats.collect():
        assert (r.total_count, r.min_val, r.max_val) == (exact[r.level].total_count, exact[r.level].min_val, exact[r.level].max_val)
    errors = [r.error for r in thresholds.rank_errors(thresholds.value_counts(df), stats).collect()]
    assert len(errors) == 3 and max(errors) <= 0.01


def test_refreshed_sketches_equal_sketches_of_all_rows(spark):
    df = indexes(spark, random.Random(2), 600)  # few enough for exact sketches
    old = df.withColumn("exposure_index", F.when(F.col("part") == 2001, F.lit(-5.0)).otherwise(F.col("exposure_index")))
    old = old.unionByName(spark.createDataFrame([("L0", 2002, 9e9)], EMPTY))  # a part that vanishes
    changed = df.where("part = 2001")
    touched = changed.select("level", "part").distinct().unionByName(spark.createDataFrame([("L0", 2002)], "level string, part int"))
    kept = thresholds.refresh_sketches(thresholds.sketches(old, "part"), thresholds.sketches(changed, "part"), touched)
    want = thresholds.sketched_percentiles(thresholds.sketches(df, "part"))
    cols = ["level", "total_count", "min_val", "p25", "p50", "p75", "max_val"]
    assert rows(thresholds.sketched_percentiles(kept), *cols) == rows(want, *cols)
    assert thresholds.sketched_percentiles(thresholds.sketches(df.where("false"), "part")).count() == 0


@pytest.mark.parametrize("keys", [[], ["vendor"]])
def test_carried_totals_equal_running_totals(spark, keys):
    draw = random.Random(3)
    day = lambda: dt.date(1997, 1, 1) + dt.timedelta(draw.randrange(2000))
    made = {(draw.choice(["a", "b", None]) if keys else "x", day()): draw.randrange(10**6) / 100 for _ in range(400)}
    made |= {("new", dt.date(2001, 5, k)): 1.25 for k in range(1, 5)} if keys else {}
    df = stored(spark.createDataFrame([(v, d, x) for (v, d), x in made.items()], "vendor string, day date, exposure_index double"), "days")
    whole = running.running_total(df, keys, "day")
    open_rows, closed = df.where("year(day) >= 2000"), df.where("year(day) < 2000")
    carried = running.carried_total(open_rows, running.closing_totals(closed, keys, "day"), keys, "day", 2000)
    assert rows(carried) == rows(whole.where("year(day) >= 2000"))
    none = running.closing_totals(closed.where("false"), keys, "day")
    assert rows(running.carried_total(closed, none, keys, "day", 1990)) == rows(running.running_total(closed, keys, "day"))


def test_watched_rows_take_one_scan(spark):
    path = shared_dir(spark, "numbers")
    spark.range(100).write.parquet(path)
    a, seen_a = quality.watch_rows(spark.read.parquet(path), "a")
    b, seen_b = quality.watch_rows(a.where("id < 30"), "b")
    assert b._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    stored(b, "numbers")
    assert rows(quality.observed_checks(spark, {"a": seen_a, "b": seen_b})) == [("a", 100), ("b", 30)]


def test_watermark_is_the_greatest_valid_from_that_was_read(spark):
    root = shared_dir(spark, "watermark")
    master = history.scd2_merge(staging.empty_master(master_source(spark, *FIRST)), master_source(spark, *FIRST), fixed.RECORD_KEY, ts(1))
    views.run(master, root, "backfill", dt.date(2023, 8, 1), at(9))
    stamp = lambda: views.read_view(spark, root, "meta").first().last_run_ts
    assert stamp() == at(1)
    views.run(master, root, "incremental", dt.date(2023, 8, 1), at(10))
    assert stamp() == at(1)


def test_empty_and_broken_archives(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    for name, data in (("empty", b""), ("full", b"one\ntwo\n")):
        with gzip.open(src / f"{name}.gz", "wb") as f:
            f.write(data)
    (src / "broken.gz").write_bytes(b"\x1f\x8b not gzip")
    (src / "nothing.gz").write_bytes(b"")  # Spark lists no files without bytes
    (src / "cut.gz").write_bytes(gzip.compress(b"")[:-3])
    done = records.gunzip_files(spark, str(src), str(dst))
    assert rows(done, "file", "ok") == [("broken", False), ("cut", False), ("empty", True), ("full", True)]
