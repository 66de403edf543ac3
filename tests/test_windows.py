from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.plans import windows as W


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 900), min_size=1, max_size=60), st.integers(1, 1000))
def test_windows_cover_all_days_once(counts, safe):
    first = date(2020, 2, 1)
    day = lambda i: first + timedelta(days=i)
    count = lambda a, b: sum(counts[(a - first).days : (b - first).days + 1])
    windows, failed = W.split_windows(first, day(len(counts) - 1), count, safe)
    covered = [a + timedelta(days=i) for a, b, _ in windows for i in range((b - a).days + 1)]
    assert len(covered) == len(set(covered)) and not failed
    assert {day(i) for i, n in enumerate(counts) if n} <= set(covered)
    assert all(n <= safe or a == b for a, b, n in windows) and sum(n for *_, n in windows) == sum(counts)


def test_days_that_cannot_be_counted():
    bad = date(2020, 1, 3)
    count = lambda a, b: None if a <= bad <= b else 1
    windows, failed = W.split_windows(date(2020, 1, 1), date(2020, 1, 5), count)
    assert failed == [(bad, bad)] and sum((b - a).days + 1 for a, b, _ in windows) == 4
    assert W.split_windows(date(2020, 1, 2), date(2020, 1, 1), count) == ([], [])


def test_half_months():
    got = W.half_month_windows(date(2020, 2, 10), date(2020, 3, 15))
    assert got == [(date(2020, 2, 10), date(2020, 2, 15)), (date(2020, 2, 16), date(2020, 2, 29)), (date(2020, 3, 1), date(2020, 3, 15))]


def test_retries_and_rate():
    tries, waits = [], []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return 7

    assert W.retried(call, sleep=waits.append) == 7 and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        W.retried(lambda: (_ for _ in ()).throw(OSError()), sleep=lambda _: None)
    now = [0.0]
    bucket = W.TokenBucket(9, 9, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(27):
        bucket.take()
    assert now[0] == pytest.approx(2.0)


def test_logs(spark):
    log = spark.createDataFrame([("a", "2020-01-01 00:00:00", True, 0, None), ("b", "2020-01-01 00:59:00", False, 2, "500")], "key string, fetched_at string, cached boolean, retries int, error string")
    assert [r[0] for r in W.fresh(log, "2020-01-01 01:00:00", 600).collect()] == ["b"]
    good, bad = W.guarded(log, "key", "pull")
    assert good.count() == 1 and tuple(bad.first()) == ("b", "pull", "500")
    assert tuple(W.counters(log).first()) == (2, 1, 2, 1)
    days = spark.createDataFrame([("2020-01-01", 5), ("2020-01-03", 900), (None, 3)], "d string, n int")
    assert W.windows_of(days, "d", "n") == [(date(2020, 1, 1), date(2020, 1, 1), 5), (date(2020, 1, 3), date(2020, 1, 3), 900)] or sum(n for *_, n in W.windows_of(days, "d", "n")) == 905
