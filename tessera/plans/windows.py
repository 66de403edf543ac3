"""Plans for paged sources: windows of dates with a bounded number of hits, retries and resumption."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hits of a window that are fetched without errors, and the most a source gives at all.
SAFE, CAP, PAGE = 700, 10_000, 100


def split_windows(first: date, last: date, count: Callable[[date, date], int | None], safe: int = SAFE) -> tuple[list[tuple[date, date, int]], list[tuple[date, date]]]:
    """(windows with hits, days given up): halves a range until it has at most safe hits.

    count says how many hits a range has, None if it cannot; a range without any is left out; a
    single day is kept whatever its number, and given up if it cannot be counted.
    """
    windows, failed, todo = [], [], [(first, last)]
    while todo:
        a, b = todo.pop()
        if a > b:
            continue
        n = count(a, b)
        if n == 0:
            continue
        if n is not None and (n <= safe or a == b):
            windows.append((a, b, n))
        elif a == b:
            failed.append((a, b))
        else:
            middle = a + (b - a) // 2
            todo += [(middle + timedelta(days=1), b), (a, middle)]
    return sorted(windows), sorted(failed)


def windows_of(counts: DataFrame, day: str, n: str, safe: int = SAFE) -> list[tuple[date, date, int]]:
    """Windows over a table of hits by day; a row a day, so it is small."""
    by_day = {r[0]: r[1] for r in counts.groupBy(F.to_date(day)).agg(F.sum(n)).collect() if r[0] is not None}
    if not by_day:
        return []
    days = sorted(by_day)
    total = lambda a, b: sum(by_day.get(a + timedelta(days=i), 0) for i in range((b - a).days + 1))
    return split_windows(days[0], days[-1], total, safe)[0]


def half_month_windows(first: date, last: date) -> list[tuple[date, date]]:
    """The halves of each month between two dates, cut to them."""
    out, at = [], first.replace(day=1)
    while at <= last:
        following = (at.replace(day=28) + timedelta(days=4)).replace(day=1)
        for a, b in ((at, at.replace(day=15)), (at.replace(day=16), following - timedelta(days=1))):
            if a <= last and b >= first:
                out.append((max(a, first), min(b, last)))
        at = following
    return out


def retried(call: Callable, attempts: int = 3, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """The value of call; tries again after a growing pause, and raises the last error."""
    for i in range(attempts):
        try:
            return call()
        except Exception:
            if i + 1 == attempts:
                raise
            sleep(wait * 2**i)


class TokenBucket:
    """Lets so many calls a second through; for one process, such as a driver that fetches."""

    def __init__(self, rate: float = 9.0, burst: float = 9.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = burst, clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1


def fresh(log: DataFrame, now: str, max_age_s: int) -> DataFrame:
    """Keys of a fetch log (key, fetched_at) that need no new fetch at a given time. Ages are in whole seconds; what was
    fetched after that time, be it by less than a second, does not count."""
    now, at = F.lit(now).cast("timestamp"), F.col("fetched_at").cast("timestamp")
    age = F.unix_timestamp(now) - F.unix_timestamp(at)
    return log.where((at <= now) & (age <= max_age_s)).select("key").distinct()


def guarded(results: DataFrame, key: str, stage: str, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rejects with key, stage, error)."""
    bad = F.col(error).isNotNull()
    return results.where(~bad), results.where(bad).select(key, F.lit(stage).alias("stage"), error)


def counters(log: DataFrame) -> DataFrame:
    """One row: requests, cache hits, retries and failures of a fetch log."""
    return log.agg(F.count("*").alias("requests"), F.count_if("cached").alias("cache_hits"), F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"), F.count_if(F.col("error").isNotNull()).alias("failures"))
