"""Tables in a folder for each date, of which single dates are read and replaced.

This is Spark's own partitioned Parquet: a date's rows are overwritten by dynamic partition overwrite, whose files
become visible when the job commits, and dates that are asked for prune the scan. Beside each table stands a
small one of digests (date, rows, hash), so that two states are compared by date before any row is read. A date's
digest is made when it is first asked for, and goes with the rows that it was made from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.sources.scratch import Files


def digests(df: DataFrame, day: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """``day, rows, hash`` of each date; the hash doesn't depend on the order of rows."""
    row = F.xxhash64(*(F.col(c) for c in sorted(df.columns) if c != day and c not in ignore))
    return df.groupBy(day).agg(F.count("*").alias("rows"), F.concat_ws("/", F.sum(row.cast("decimal(20,0)")).cast("string"), F.bit_xor(row).cast("string")).alias("hash"))


def dates_of(df: DataFrame, day: str = "tanggal") -> list[dt.date]:
    """The dates of a table: as many as there are days in the calendar, so the driver may have them."""
    return sorted(r[0] for r in df.select(day).distinct().collect() if r[0] is not None)


class DatedTables:
    """Tables below ``path``; ``days`` names the date column of each."""

    def __init__(self, spark: SparkSession, path: str, days: dict[str, str]):
        self.spark, self.path, self.days = spark, path, days

    def _at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def write(self, name: str, df: DataFrame) -> None:
        """All dates of a table, in place of what was there."""
        day, old = self.days[name], Files(self.spark, self._at(name) + "-digests")
        old.delete()
        df.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(self._at(name))
        old.delete()

    def read(self, name: str, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """A table, or some of its dates: the others' folders aren't read."""
        df = self.spark.read.parquet(self._at(name))
        return df if dates is None else df.where(F.col(self.days[name]).isin(list(dates)))

    def _dates(self, table: str) -> set[dt.date]:
        """The dates that have a folder."""
        values = (f.partition("=")[2] for f in Files(self.spark, self._at(table)).names())
        return {dt.date.fromisoformat(v) for v in values if v and not v.startswith("__")}

    def digests(self, name: str) -> DataFrame:
        """``day, rows, hash`` of all dates; those without a digest are read for it."""
        day, path = self.days[name], self._at(name) + "-digests"
        todo = self._dates(name) - self._dates(f"{name}-digests")
        if todo:
            digests(self.read(name, todo), day).coalesce(1).write.mode("append").partitionBy(day).parquet(path)
        return self.spark.read.schema(f"rows BIGINT, hash STRING, {day} DATE").parquet(path) if self._dates(f"{name}-digests") else digests(self.read(name), day)

    def replace(self, name: str, rows: DataFrame, dates: list[dt.date]) -> None:
        """Put ``rows`` in place of all that these dates hold; a date without rows loses its folder.

        Running it again gives the same table. ``rows`` may read the table itself: new files are staged and moved when the job commits.
        """
        if not dates:
            return
        day = self.days[name]
        seen, counts = Observation(), {f"d{d:%Y%m%d}": F.count_if(F.col(day) == d) for d in dates}
        rows = rows.where(F.col(day).isin(dates)).observe(seen, *(c.alias(n) for n, c in counts.items()))
        self.drop(f"{name}-digests", day, dates)  # before, so that a crash leaves no digest of rows that are gone
        rows.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(self._at(name))
        self.drop(name, day, [d for d in dates if not seen.get[f"d{d:%Y%m%d}"]])
        self.drop(f"{name}-digests", day, dates)  # after, for one that was asked for meanwhile

    def drop(self, table: str, day: str, dates: Iterable[dt.date]) -> None:
        for d in dates:
            Files(self.spark, f"{self._at(table)}/{day}={d}").delete()

    def folders(self, name: str) -> dict[str, list[str]]:
        """The files of each date's folder."""
        return {f: Files(self.spark, f"{self._at(name)}/{f}").names() for f in Files(self.spark, self._at(name)).names() if "=" in f}

    def changed_dates(self, name: str, new: DataFrame, ignore: tuple[str, ...] = ()) -> list[dt.date]:
        """Dates whose rows differ from the stored ones, told by digests alone."""
        day = self.days[name]
        stored = digests(self.read(name), day, ignore) if ignore else self.digests(name)
        both = digests(new, day, ignore).withColumn("side", F.lit(1)).unionByName(stored.select(day, "rows", "hash").withColumn("side", F.lit(2)))
        return dates_of(both.groupBy(day, "rows", "hash").agg(F.sum("side").alias("sides")).where("sides <> 3"), day)
