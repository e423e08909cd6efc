"""Popularity sums moved from day to day against sums computed anew."""

import datetime as dt
import random

import pytest

from affinity.operators import popularity, rolling
from affinity.plans import jobs
from affinity.session import shared_dir
from affinity.sources import sinks, snapshots

FIRST = dt.date(2024, 1, 1)
SCHEMA = "sess_id long, user_id long, product_id long, event string, event_uv int, event_time date"


def _rows(seed, days, per_day=25, skip=()):
    r = random.Random(seed)
    out = [(i, 1, r.choice([1, 1, 1, *range(2, 12), None]), r.choice(["order", "cart", "wish", "click", "error"]),
            r.choice([1, 1, 1, 0, None]), FIRST + dt.timedelta(days=d))
           for d in days if d not in skip for i in range(per_day)]
    return out


def _write(spark, rows, path):
    sinks.write_daily_events(spark.createDataFrame(rows, SCHEMA), path)


def _set(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def _same(spark, daily, state, end, days):
    got = rolling.advance(spark, daily, state, end, days)
    want = popularity.window_sums(snapshots.read(spark, daily), end, days)
    # a product whose rows are all outside every event's windows is listed by neither
    empty = " AND ".join(f"{c} IS NULL" for c in want.columns if c != "product_id")
    assert _set(got) == _set(want.where(f"NOT ({empty})")), end


def test_sixty_shifted_days_move_every_day_in_and_out_once():
    # what a row of a day adds over all steps is its place in the windows of the last end
    days = [FIRST + dt.timedelta(days=i) for i in range(-70, 70)]
    held, old = {}, None
    for i in range(60):
        new = popularity.Windows.of(FIRST + dt.timedelta(days=i), 31)
        moved = rolling.moved_days(old, new)
        for d in days:
            step = {k: (lo <= d <= hi) - (old is not None and old.ranges()[k][0] <= d <= old.ranges()[k][1])
                    for k, (lo, hi) in new.ranges().items()}
            assert any(step.values()) == (d in moved)
            for k, n in step.items():
                held[d, k] = held.get((d, k), 0) + n
        assert all(held[d, k] == (lo <= d <= hi) for d in days for k, (lo, hi) in new.ranges().items())
        old = new


def test_shifted_days_equal_the_sums_computed_anew(spark):
    root = shared_dir(spark, "test-rolling")
    daily, state = f"{root}/daily", f"{root}/state"
    _write(spark, _rows(1, range(75), skip=(20, 21, 40)), daily)
    for i in (0, 1, 2, 9, 40, 60):
        _same(spark, daily, state, FIRST + dt.timedelta(days=12 + i), 12)


def test_jumps_back_and_forth_other_lengths_and_a_rerun(spark):
    root = shared_dir(spark, "test-rolling")
    daily, state = f"{root}/daily", f"{root}/state"
    _write(spark, _rows(2, range(40)), daily)
    for day, days in ((30, 9), (30, 9), (12, 9), (39, 14), (400, 14), (25, 14)):
        _same(spark, daily, state, FIRST + dt.timedelta(days=day), days)


def test_days_written_again_late_or_without_rows(spark):
    root = shared_dir(spark, "test-rolling")
    daily, state = f"{root}/daily", f"{root}/state"
    _write(spark, _rows(3, range(30), skip=(24,)), daily)
    end = FIRST + dt.timedelta(days=27)
    _same(spark, daily, state, end, 9)
    _write(spark, _rows(4, [24]), daily)                        # came late
    _same(spark, daily, state, end, 9)
    _write(spark, _rows(5, [22]), daily)                        # written again
    _same(spark, daily, state, end + dt.timedelta(days=1), 9)
    again = [(1, 1, 5, "error", 1, FIRST + dt.timedelta(days=25))]   # written again, no event counts
    _write(spark, again, daily)
    _same(spark, daily, state, end + dt.timedelta(days=2), 9)


def test_a_step_reads_the_days_that_differ_and_counts_the_new_one(spark, monkeypatch):
    root = shared_dir(spark, "test-rolling")
    daily, state = f"{root}/daily", f"{root}/state"
    _write(spark, _rows(6, range(80)), daily)
    end = FIRST + dt.timedelta(days=70)
    rolling.advance(spark, daily, state, end, 60)
    seen, real = {}, snapshots.read

    def watched(spark, path, parts=None):
        df = real(spark, path, parts)
        if parts is not None:
            seen[path] = {f.split("event_time=")[1].split("/")[0] for f in df.inputFiles()}
        return df

    monkeypatch.setattr(rolling.snapshots, "read", watched)
    rolling.advance(spark, daily, state, end + dt.timedelta(days=1), 60)
    old, new = (popularity.Windows.of(end + dt.timedelta(days=i), 60) for i in (0, 1))
    moved = rolling.moved_days(old, new)
    assert seen[daily] == {str(new.end)}                         # events: the new day alone
    assert seen[f"{state}/days"] == {str(d) for d in moved} and len(moved) == 8
    seen.clear()
    rolling.advance(spark, daily, state, end + dt.timedelta(days=1), 60)
    assert seen == {}


def test_a_run_that_breaks_leaves_the_state_valid(spark, monkeypatch):
    root = shared_dir(spark, "test-rolling")
    daily, state = f"{root}/daily", f"{root}/state"
    _write(spark, _rows(7, range(30)), daily)
    end = FIRST + dt.timedelta(days=20)
    rolling.advance(spark, daily, state, end, 9)
    with monkeypatch.context() as m:
        m.setattr(rolling, "moved_sums", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rolling.advance(spark, daily, state, end + dt.timedelta(days=4), 9)
    assert snapshots.manifest(spark, f"{state}/sums")["note"]["end"] == str(end)
    _same(spark, daily, state, end + dt.timedelta(days=5), 9)


def test_job_with_state_writes_the_same_table(spark):
    root = shared_dir(spark, "test-rolling")
    daily = f"{root}/daily"
    _write(spark, _rows(8, range(50)), daily)
    for day in (45, 46):
        args = ["popularity", "--daily", daily, "--end", str(FIRST + dt.timedelta(days=day)), "--days", "30"]
        jobs.main([*args, "--out", f"{root}/a", "--state", f"{root}/state"])
        jobs.main([*args, "--out", f"{root}/b"])
        a, b = (snapshots.read(spark, f"{root}/{x}") for x in "ab")
        assert a.count() > 0 and _set(a) == _set(b)


def test_tables_without_manifest_or_with_other_events_are_errors(spark):
    root = shared_dir(spark, "test-rolling")
    with pytest.raises(ValueError):
        rolling.advance(spark, f"{root}/none", f"{root}/state", "2024-01-31", 9)
    _write(spark, _rows(9, range(5)), f"{root}/daily")
    rolling.advance(spark, f"{root}/daily", f"{root}/state", "2024-01-05", 9)
    with pytest.raises(ValueError):
        rolling.advance(spark, f"{root}/daily", f"{root}/state", "2024-01-05", 9, names=("order",))
