"""Curated tables and the mart kept by date: what changes is computed and written for its dates only.

:class:`CuratedStore` holds enriched events, leave days, population and daily records; a correction replaces the rows of its
dates and computes the affected employees of these dates anew. :class:`MartStore` holds the facts and what is summed from
them; a delivery replaces the facts of its dates and sums these dates anew. Each step may be run again after a failure
and gives the same tables; between the facts' commit and the sums' a reader can see a date's new facts beside its old sums.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import curated, mart, people
from rollcall.operators.incremental import KEYS, affected_keys, changed_rows
from rollcall.sources.dated import DatedTables, dates_of
from rollcall.sources.scratch import scratch, written

CURATED = {"events": "tanggal_event", "leave_days": "tanggal", "population": "tanggal", "daily": "tanggal"}
MART = {"fact": "tanggal", "agg": "tanggal", "people": "tanggal"}


class CuratedStore(DatedTables):
    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, CURATED)

    def build(self, events: DataFrame, leave_days: DataFrame, population: DataFrame) -> None:
        for name, df in (("events", events.where("tanggal_event is not null")), ("leave_days", leave_days), ("population", population)):
            self.write(name, df)
        self.write("daily", curated.unified_daily(self.read("population"), self.read("events"), curated.leave_daily(self.read("leave_days"))))

    def _mine(self, name: str, keys: DataFrame, dates: list[dt.date]) -> DataFrame:
        day = self.days[name]
        return self.read(name, dates).join(keys.withColumnRenamed("tanggal", day).hint("shuffle_hash"), ["pegawai_id", day], "left_semi")

    def fresh(self, keys: DataFrame, dates: list[dt.date]) -> DataFrame:
        """Daily records of the affected employees and dates, from the stored inputs of these dates."""
        return curated.unified_daily(self._mine("population", keys, dates), self._mine("events", keys, dates), curated.leave_daily(self._mine("leave_days", keys, dates)))

    def recompute(self, keys: DataFrame) -> list[dt.date]:
        """Compute the affected daily records anew; keys that nothing supports any more vanish. Returns their dates."""
        keys = written(keys.select(*KEYS).distinct(), "affected")
        dates = dates_of(keys)
        if dates:
            self.replace("daily", self.read("daily", dates).join(keys.hint("shuffle_hash"), KEYS, "left_anti").unionByName(self.fresh(keys, dates)), dates)
        return dates

    def take(self, name: str, rows: DataFrame, ids: list[str]) -> DataFrame:
        """Put rows in place of stored ones with the same ``ids``, on the dates of both. Returns the keys that they touch, to be recomputed.

        Old rows on other dates than the new one's are found by their id on all dates; the scan reads the ids only.
        """
        day = self.days[name]
        rows = written(rows.where(F.col(day).isNotNull()), "taken")
        old = written(self.read(name).select(*ids, "pegawai_id", day).join(rows.select(*ids).distinct().hint("shuffle_hash"), ids, "left_semi"), "replaced")
        keys = affected_keys(*(x.select("pegawai_id", F.col(day).alias("tanggal")) for x in (rows, old)))
        dates = sorted({*dates_of(rows, day), *dates_of(old, day)})
        if dates:
            kept = self.read(name, dates).join(rows.select(*ids).distinct().hint("shuffle_hash"), ids, "left_anti")
            self.replace(name, kept.unionByName(rows.select(*kept.columns)), dates)
        return keys

    def correct(self, events: DataFrame | None = None, leave_days: DataFrame | None = None) -> list[dt.date]:
        """Late or corrected events, enriched, of any age, and corrected leaves as all their days: a date is computed anew once for both.

        Events count on the dates on which they happened; days that a leave has lost go.
        """
        new = (("events", events, ["event_id"]), ("leave_days", leave_days, ["perizinan_id"]))
        keys = [self.take(name, rows, ids) for name, rows, ids in new if rows is not None]
        return self.recompute(affected_keys(*keys)) if keys else []

    def late_events(self, events: DataFrame) -> list[dt.date]:
        return self.correct(events=events)

    def late_leaves(self, leave_days: DataFrame) -> list[dt.date]:
        return self.correct(leave_days=leave_days)

    def changed(self, name: str, new: DataFrame, key: str) -> DataFrame:
        """Keys of rows that are new or differ: dates are compared by digest, and rows only on dates that differ."""
        dates = self.changed_dates(name, new)
        return changed_rows(new.where(F.col(self.days[name]).isin(dates)), self.read(name, dates), key)


class MartStore(DatedTables):
    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, MART)

    def build(self, fact: DataFrame) -> None:
        self.write("fact", fact)
        self.write("agg", mart.department_day_sum(self.read("fact")))
        self.write("people", people.people_bitmaps(self.read("fact")))

    def deliver(self, items: DataFrame, candidates: DataFrame) -> list[dt.date]:
        """Apply one delivery (keys and ``operation``; the upserts' rows as facts). Only dates that change are written; returns them."""
        named = dates_of(items)
        if not named:
            return []
        before = self.read("fact", named)
        deleted = items.where("operation = 'DELETE'").select(*KEYS)
        upserts = candidates.join(items.where("operation = 'UPSERT'").select(*KEYS), KEYS, "left_semi").select(*before.columns)
        changed = written(upserts.exceptAll(before), "changed")
        gone = written(before.select(*KEYS).join(deleted, KEYS, "left_semi"), "gone")
        dates = dates_of(changed.select("tanggal").unionByName(gone.select("tanggal")))
        if dates:
            out = changed.select(*KEYS).unionByName(gone)
            self.replace("fact", self.read("fact", dates).join(out, KEYS, "left_anti").unionByName(changed), dates)
            self.replace("agg", mart.department_day_sum(self.read("fact", dates)), dates)
            self.replace("people", people.people_bitmaps(self.read("fact", dates)), dates)
        return dates


# Queries: stores that are built in an older state and brought up to date.
def _nobody() -> Column:
    """A number that no employee has, whatever the size of the master."""
    return -1 - F.col("pegawai_id")


def _store(t, events: DataFrame, leave_days: DataFrame) -> CuratedStore:
    store = CuratedStore(t.spark, scratch(t.spark, "curated"))
    store.build(events, leave_days, t.pop)
    return store


def _after_late(t, table: str) -> DataFrame:
    """Some events come late, some leaves are moved and some withdrawn before the store hears of it."""
    late = F.col("event_id") % 50 == 3
    days = t.lvday.withColumn("tanggal", F.when(F.col("perizinan_id") % 40 == 1, F.date_add("tanggal", 1)).otherwise(F.col("tanggal")))
    store = _store(t, t.ev.where(~late), days)
    store.correct(t.ev.where(late), t.lvday.where("perizinan_id % 40 = 1"))
    return store.read(table)


def _recomputed(t) -> DataFrame:
    """Stored daily records of two dates are wrong: some employees lack, some have no ground any more."""
    store, days = _store(t, t.ev, t.lvday), [dt.date(2024, 1, 8), dt.date(2024, 1, 15)]
    rows = store.read("daily", days)
    wrong = rows.where("pegawai_id % 3 <> 0").unionByName(rows.where("pegawai_id % 6 = 0").withColumn("pegawai_id", _nobody()))
    keys = written(rows.select(*KEYS).where("pegawai_id % 3 = 0").unionByName(wrong.select(*KEYS).where("pegawai_id < 0")), "keys")
    store.replace("daily", wrong, days)
    store.recompute(keys)
    return store.read("daily")


def _delivered(t, table: str) -> DataFrame:
    """A mart without some employees of a date and with employees that are to go; one delivery puts both right."""
    store, day = MartStore(t.spark, scratch(t.spark, "mart")), F.col("tanggal") == dt.date(2024, 1, 8)
    fact = written(t.fact, "fact")
    store.build(fact.where(~day | (F.col("pegawai_id") % 3 > 0)).unionByName(fact.where(day & (F.col("pegawai_id") % 7 == 0)).withColumn("pegawai_id", _nobody())))
    new = fact.where(day & (F.col("pegawai_id") % 3 == 0)).select(*KEYS, F.lit("UPSERT").alias("operation"))
    gone = fact.where(day & (F.col("pegawai_id") % 7 == 0)).select(_nobody().alias("pegawai_id"), "tanggal", F.lit("DELETE").alias("operation"))
    store.deliver(new.unionByName(gone), fact)
    return store.read(table)


def _changed(t) -> DataFrame:
    store = CuratedStore(t.spark, scratch(t.spark, "curated"))
    keyed = t.daily.select(F.concat_ws("/", *KEYS).alias("k"), *KEYS, "leave_days", "lateness_status")
    store.write("daily", keyed)
    changed = (F.dayofmonth("tanggal") % 10 == 4) & (F.col("pegawai_id") % 5 == 0)
    return store.changed("daily", keyed.withColumn("leave_days", F.when(changed, 9).otherwise(F.col("leave_days"))), "k")


QUERIES = {
    "recompute_stored": (_recomputed, "SELECT * FROM {daily}"),
    "late_correction_stored": (lambda t: _after_late(t, "daily"), "SELECT * FROM {daily}"),
    "mart_upkeep_fact": (lambda t: _delivered(t, "fact"), "SELECT * FROM {fact}"),
    "mart_upkeep_sums": (lambda t: _delivered(t, "agg"), "SELECT * FROM {agg}"),
    "mart_upkeep_people": (
        lambda t: people.unique_people(_delivered(t, "people"), dt.date(2024, 1, 5), dt.date(2024, 1, 20)),
        "SELECT count(DISTINCT pegawai_id) AS people FROM {fact} WHERE active_employee_days = 1 AND tanggal BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
    "changed_rows_by_digest": (_changed, "SELECT concat_ws('/', pegawai_id, tanggal) AS k FROM {daily} WHERE day(tanggal) % 10 = 4 AND pegawai_id % 5 = 0"),
}
