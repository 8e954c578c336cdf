"""The half-open time window a report covers."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.schema import LOCAL_UTC_OFFSET_HOURS, LOCAL_ZONE, POLL_MINUTES
from quotelake.sources.lake import DAY_OF

_LOCAL = timezone(timedelta(hours=LOCAL_UTC_OFFSET_HOURS))
# The default session, local time.
SESSION_START, SESSION_END = "09:45", "18:00"


@dataclass(frozen=True)
class ReportWindow:
    """``[start, end)`` as aware datetimes."""

    start: datetime
    end: datetime

    def __post_init__(self):
        if self.end <= self.start:
            raise ValueError(f"window end {self.end} must be after its start {self.start}")

    @classmethod
    def session(cls, day: str, start: str = SESSION_START,
                end: str = SESSION_END) -> ReportWindow:
        """Local date and clock times; the local offset is fixed (no daylight saving)."""
        return cls.local(f"{day} {start}", f"{day} {end}")

    @classmethod
    def local(cls, start: str, end: str) -> ReportWindow:
        """Local dates and times, ``YYYY-MM-DD HH:MM``."""
        return cls(*(datetime.strptime(text, "%Y-%m-%d %H:%M").replace(tzinfo=_LOCAL)
                     for text in (start, end)))

    @classmethod
    def utc(cls, start: str, end: str) -> ReportWindow:
        """ISO date-times in UTC."""
        return cls(*(datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
                     for text in (start, end)))

    @classmethod
    def last_day(cls, now: datetime) -> ReportWindow:
        """The 24 hours up to ``now``."""
        return cls(now - timedelta(days=1), now)

    @property
    def minutes(self) -> int:
        return int((self.end - self.start).total_seconds() // 60)

    @property
    def expected_cycles(self) -> int:
        """Polls that fall into the window, the one at its start included."""
        return -(-self.minutes // POLL_MINUTES)

    def holds(self, time_col: str) -> Column:
        """Predicate on a timestamp column; literal bounds, so it reaches the scan."""
        return (F.col(time_col) >= _instant(self.start)) & (F.col(time_col) < _instant(self.end))

    @property
    def label(self) -> str:
        first, last = (moment.astimezone(_LOCAL) for moment in (self.start, self.end))
        return f"{first:%Y-%m-%d %H:%M} to {last:%Y-%m-%d %H:%M} {LOCAL_ZONE}"

    def apply(self, df: DataFrame, time_col: str) -> DataFrame:
        """Rows in the window; folders of other days are not read where the day is at hand."""
        day = next((c for c, source in DAY_OF.items() if source == time_col and c in df.columns), None)
        if day:
            first, last = (moment.astimezone(timezone.utc) for moment in (self.start, self.end))
            df = df.filter(F.col(day).between(f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}"))
        return df.filter(self.holds(time_col))


def local_today() -> str:
    """Today's local date."""
    return f"{datetime.now(_LOCAL):%Y-%m-%d}"


def _instant(moment: datetime) -> Column:
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((moment - epoch) // timedelta(microseconds=1)))


def describe_window(anchor: DataFrame, window: ReportWindow, tickers: int) -> DataFrame:
    """One row with the bounds and what they imply. ``anchor`` only lends its session."""
    return anchor.sparkSession.range(1).select(
        _instant(window.start).alias("start_utc"),
        _instant(window.end).alias("end_utc"),
        *_constants(tickers, F.lit(window.expected_cycles)))


def session_windows(bronze: DataFrame, tickers: int, start: str = SESSION_START,
                    end: str = SESSION_END) -> DataFrame:
    """The same row for every local day on which messages arrived."""
    cycles = ReportWindow.session("2000-01-01", start, end).expected_cycles
    zone = f"{LOCAL_UTC_OFFSET_HOURS:+03d}:00"

    def bound(clock: str) -> Column:
        text = F.concat_ws(" ", F.col("day").cast("string"), F.lit(f"{clock}:00"))
        return F.to_utc_timestamp(F.to_timestamp(text), zone)

    days = (
        bronze.filter(F.col("kafka_time").isNotNull())
        .select(F.to_date(F.from_utc_timestamp("kafka_time", zone)).alias("day")).distinct()
    )
    return days.select(
        bound(start).alias("start_utc"), bound(end).alias("end_utc"),
        *_constants(tickers, F.lit(cycles))).orderBy("start_utc")


def _constants(tickers: int, cycles: Column) -> list[Column]:
    return [
        F.lit(LOCAL_ZONE).alias("local_zone"),
        F.lit(POLL_MINUTES).alias("poll_minutes"),
        cycles.cast("bigint").alias("expected_cycles"),
        F.lit(tickers).alias("tickers"),
    ]
