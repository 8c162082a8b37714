"""Fiscal calendars whose periods have any length, as lookups that live in the plan.

A calendar has a few hundred periods, so its bounds travel as short literal arrays. A date finds its period
by one array access and one comparison, in generated code: no join, no month arithmetic and no job while planning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = timedelta(days=1)


@dataclass(frozen=True)
class Period:
    """``id`` is the fiscal year times 100 plus the number in the year; ``quarter`` the number of its quarter."""

    id: int
    start: date
    end: date
    quarter: int

    @property
    def year(self) -> int:
        return self.id // 100

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1


class FiscalCalendar:
    """Consecutive periods without gaps. ``Column`` methods take and give places, counted from 0; null and anything
    beyond the calendar give null."""

    def __init__(self, periods: Iterable[Period]) -> None:
        self.periods = sorted(periods, key=lambda p: p.start)
        if not self.periods:
            raise ValueError("a calendar needs periods")
        for a, b in zip(self.periods, self.periods[1:], strict=False):
            if b.start != a.end + DAY or b.id <= a.id:
                raise ValueError(f"period {b.id} does not follow {a.id}")
        self.origin = self.periods[0].start
        self.lengths = tuple(sorted({p.days for p in self.periods}))

    @classmethod
    def months(cls, first: int = 199001, last: int = 203912) -> FiscalCalendar:
        """Gregorian months."""
        out = []
        while first <= last:
            year, month = divmod(first, 100)
            following = date(year + month // 12, month % 12 + 1, 1)
            out.append(Period(first, date(year, month, 1), following - DAY, (month + 2) // 3))
            first = following.year * 100 + following.month
        return cls(out)

    @classmethod
    def weeks(cls, start: date, year: int, years: int, pattern: Sequence[int] = (4, 4, 5), long_years: Sequence[int] = ()) -> FiscalCalendar:
        """Quarters of ``pattern`` weeks from ``start``, the first day of fiscal ``year``; the last period of a long year
        has one week more."""
        out = []
        for y in range(year, year + years):
            for n in range(4 * len(pattern)):
                extra = y in long_years and n == 4 * len(pattern) - 1
                end = start + timedelta(weeks=pattern[n % len(pattern)] + extra) - DAY
                out.append(Period(y * 100 + n + 1, start, end, n // len(pattern) + 1))
                start = end + DAY
        return cls(out)

    @classmethod
    def read(cls, calendar: DataFrame) -> FiscalCalendar:
        """From a table of periods (prd_id, start_date, end_date, qtr_num), one row each; they are fetched here, once."""
        rows = calendar.select("prd_id", "start_date", "end_date", "qtr_num").collect()
        return cls(Period(r["prd_id"], r["start_date"], r["end_date"], r["qtr_num"]) for r in rows)

    @classmethod
    def of(cls, calendar: FiscalCalendar | DataFrame) -> FiscalCalendar:
        return calendar if isinstance(calendar, FiscalCalendar) else cls.read(calendar)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row for each period: prd_id, start_date, end_date, period_year, qtr_num."""
        at = F.col("id").cast("int")
        return spark.range(0, len(self.periods), 1, 1).select(
            self.id_at(at).alias("prd_id"), self.start_at(at).alias("start_date"), self.end_at(at).alias("end_date"),
            (self.id_at(at) / 100).cast("int").alias("period_year"), self.quarter_at(at).alias("qtr_num"),
        )

    @staticmethod
    def _array(numbers: Iterable[int | None]) -> Column:
        """An array literal, -1 for what there isn't; the optimizer evaluates the split and the cast once."""
        return F.split(F.lit(",".join("-1" if n is None else str(n) for n in numbers)), ",").cast("array<int>")

    @staticmethod
    def _get(array: Column, at: Column) -> Column:
        return F.get(array, at)

    @staticmethod
    def _place(array: Column, at: Column) -> Column:
        return F.nullif(F.get(array, at), F.lit(-1))

    def _off(self, day: date) -> int:
        return (day - self.origin).days

    @cached_property
    def _bucket_days(self) -> int:
        return self.lengths[0]  # a bucket then meets two periods at most

    @cached_property
    def _first_of_bucket(self) -> Column:
        places, at = [], 0
        for first in range(0, self._off(self.periods[-1].end) + 1, self._bucket_days):
            while self._off(self.periods[at].end) < first:
                at += 1
            places.append(at)
        return self._array(places)

    @cached_property
    def _ends(self) -> Column:
        return self._array(self._off(p.end) for p in self.periods)

    @cached_property
    def _starts(self) -> Column:
        return self._array(self._off(p.start) for p in self.periods)

    @cached_property
    def _ids(self) -> Column:
        return self._array(p.id for p in self.periods)

    @cached_property
    def _quarters(self) -> Column:
        return self._array(p.quarter for p in self.periods)

    @cached_property
    def _days(self) -> Column:
        return self._array(p.days for p in self.periods)

    @cached_property
    def _per_year(self) -> int:
        return max(p.id % 100 for p in self.periods)

    @cached_property
    def _by_id(self) -> Column:
        places = {p.id: at for at, p in enumerate(self.periods)}
        years = range(self.periods[0].year, self.periods[-1].year + 1)
        return self._array(places.get(y * 100 + n) for y in years for n in range(1, self._per_year + 1))

    @cached_property
    def _counts(self) -> dict[int, Column]:
        """By length: how many periods of that length there are up to and including each place."""
        out = {}
        for days in self.lengths:
            n, so_far = 0, []
            for p in self.periods:
                n += p.days == days
                so_far.append(n)
            out[days] = self._array(so_far)
        return out

    def off(self, day: Column) -> Column:
        """Days since the calendar's first."""
        return F.datediff(day, F.lit(self.origin))

    def place_at(self, off: Column) -> Column:
        """The place of the period that holds the day ``off`` days after the first."""
        inside = F.when((off >= 0) & (off <= self._off(self.periods[-1].end)), off)
        first = self._get(self._first_of_bucket, F.call_function("div", inside, F.lit(self._bucket_days)).cast("int"))
        return first + (off > self._get(self._ends, first)).cast("int")

    def place(self, day: Column) -> Column:
        """The place of the period that holds a date."""
        return self.place_at(self.off(day))

    def place_of(self, prd: Column) -> Column:
        """The place of a period id."""
        n = prd % 100
        address = ((prd / 100).cast("int") - self.periods[0].year) * self._per_year + n - 1
        return self._place(self._by_id, F.when(n.between(1, self._per_year) & (prd >= self.periods[0].id), address.cast("int")))

    def id_at(self, at: Column) -> Column:
        return self._get(self._ids, at)

    def start_at(self, at: Column) -> Column:
        return F.date_add(F.lit(self.origin), self._get(self._starts, at))

    def end_off_at(self, at: Column) -> Column:
        return self._get(self._ends, at)

    def end_at(self, at: Column) -> Column:
        return F.date_add(F.lit(self.origin), self.end_off_at(at))

    def days_at(self, at: Column) -> Column:
        return self._get(self._days, at)

    def quarter_at(self, at: Column) -> Column:
        return self._get(self._quarters, at)

    def count_at(self, days: int, at: Column) -> Column:
        """Periods of ``days`` days up to and including the place."""
        return self._get(self._counts[days], at).cast("bigint")

    def _last_before(self, key) -> Column:
        """By place: the last place whose key differs from that of the place's own run, so the end of the run before."""
        out: list[int | None] = []
        for at, p in enumerate(self.periods):
            if at and key(self.periods[at - 1]) == key(p):
                out.append(out[-1])
            else:
                out.append(at - 1 if at else None)
        return self._array(out)

    @cached_property
    def _year_before(self) -> Column:
        return self._last_before(lambda p: p.year)

    @cached_property
    def _quarter_before(self) -> Column:
        return self._last_before(lambda p: (p.year, p.quarter))

    def year_end_before(self, at: Column) -> Column:
        """The last place of the fiscal year before that of a place."""
        return self._place(self._year_before, at)

    def quarter_end_before(self, at: Column) -> Column:
        return self._place(self._quarter_before, at)

    def period_before(self, at: Column) -> Column:
        return F.when(at > 0, at - 1)

    def sure(self, place: Column, asked: Column) -> Column:
        """The place, or a failed job if what was ``asked`` for is not null and lies beyond the calendar.

        A period that the calendar lacks would drop out of the schedules and its amount be lost. The check is part
        of the value and no filter, which would be computed a second time where the rows are read.
        """
        text = F.lit(f"dates outside the calendar, {self.origin} to {self.periods[-1].end}")
        return F.coalesce(place, F.when(asked.isNotNull(), F.raise_error(text).cast("int")))
