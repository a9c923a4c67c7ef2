"""Change capture from a stream of row writes: the last write of a key wins, and writes that change nothing are passed over.

Writes arrive as files (keys, ``sequence``, ``deleted`` and the row). A micro-batch gives one image for each key that it touches, the
newest of its writes, whatever their order. Images are written by batch: a batch that is run again after a failure replaces its own
rows. What is pending is compared with the acknowledged images, which are kept as one base: a key has one change however often
it was written, none if it is what it was, and none from a write that is older than its base. The base is the stream's state: files, so
that no executor has to hold the images of all keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.operators.incremental import JSON, KEYS
from rollcall.sources.scratch import Files, scratch, written

IMAGE = "pegawai_id INT, tanggal DATE, sequence BIGINT, payload STRING, digest BIGINT"


def images(writes: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Writes as ``keys, sequence, payload, digest``; a deleted row has neither. ``ignore`` columns don't make a difference."""
    row = [c for c in writes.columns if c not in ("sequence", "deleted")]
    compared = [F.to_json(F.struct(c), JSON) for c in row if c not in (*KEYS, *ignore)]
    live = ~F.coalesce("deleted", F.lit(False))
    return writes.select(*KEYS, "sequence", F.when(live, F.to_json(F.struct(*row), JSON)).alias("payload"), F.when(live, F.xxhash64(*compared)).alias("digest"))


def newest(rows: DataFrame) -> DataFrame:
    """The image of the highest sequence of each key."""
    last = rows.groupBy(*KEYS).agg(F.max_by(F.struct("sequence", "payload", "digest"), "sequence").alias("last"))
    return last.select(*KEYS, "last.*")


class ChangeCapture:
    """Captures the writes that lie in ``inbox`` to ``path``; ``of`` is the schema of the writes."""

    def __init__(self, spark: SparkSession, inbox: str, path: str, of: StructType, ignore: tuple[str, ...] = ()):
        self.spark, self.inbox, self.path, self.of, self.ignore = spark, inbox, path, of, ignore

    def run(self) -> None:
        """Capture all that has arrived, from where the checkpoint stands."""
        arrived = self.spark.readStream.schema(self.of).parquet(f"{self.inbox}/*")

        def keep(batch: DataFrame, number: int) -> None:
            newest(images(batch, self.ignore)).write.mode("overwrite").parquet(f"{self.path}/images/batch={number}")

        query = arrived.writeStream.option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
        query.awaitTermination()

    def _numbers(self, folder: str) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in Files(self.spark, f"{self.path}/{folder}").names() if "=" in n)

    def batches(self) -> int:
        """How many batches have been captured."""
        return max((n + 1 for n in self._numbers("images")), default=0)

    def _base(self) -> tuple[int, DataFrame]:
        """How many batches are acknowledged, and the images that they left."""
        done = max(self._numbers("base"), default=0)
        return done, self.spark.read.schema(IMAGE).parquet(f"{self.path}/base/upto={done}") if done else self.spark.createDataFrame([], IMAGE)

    def _after(self, done: int) -> DataFrame:
        here = [f"{self.path}/images/batch={n}" for n in self._numbers("images") if n >= done]
        return self.spark.read.schema(IMAGE).parquet(*here) if here else self.spark.createDataFrame([], IMAGE)

    def acknowledge(self, batches: int) -> None:
        """The receiver has all changes of the first ``batches`` batches; their images become the base. Acknowledging again changes nothing."""
        done, base = self._base()
        if batches <= done:
            return
        if batches > self.batches():
            raise ValueError("batches that weren't captured can't be acknowledged")
        last = [f"{self.path}/images/batch={n}" for n in self._numbers("images") if done <= n < batches]
        newest(base.unionByName(self.spark.read.schema(IMAGE).parquet(*last))).write.mode("overwrite").parquet(f"{self.path}/base/upto={batches}")

    def pending(self) -> DataFrame:
        """``keys, operation, payload``: what the keys written since the last acknowledgement are now, where that differs from what they were."""
        done, base = self._base()
        now = newest(self._after(done))
        both = now.join(base.select(*KEYS, F.col("digest").alias("was"), F.col("sequence").alias("upto")), KEYS, "left")
        both = both.where(~F.col("digest").eqNullSafe(F.col("was")) & (F.col("upto").isNull() | (F.col("sequence") > F.col("upto"))))
        return both.select(*KEYS, F.when(F.col("payload").isNull(), "DELETE").otherwise("UPSERT").alias("operation"), "payload")


def _captured(t) -> DataFrame:
    """Writes after an acknowledged first state: some keys are written three times, all rows once more, and some are deleted; with a restart between."""
    inbox, path = scratch(t.spark, "writes"), scratch(t.spark, "captured")
    daily = written(t.daily.select(*KEYS, "leave_days", "lateness_status", "lateness_event_id"), "daily")
    old = daily.where("pegawai_id % 11 <> 0").withColumn("leave_days", F.when(F.col("pegawai_id") % 13 == 0, 7).otherwise(F.col("leave_days")))
    several = daily.where("pegawai_id % 17 <> 0 and (pegawai_id % 11 = 0 or pegawai_id % 13 = 0)")
    write = lambda df, n, gone: df.withColumn("sequence", F.lit(n).cast("long")).withColumn("deleted", gone).write.parquet(f"{inbox}/{n}")
    write(old, 1, F.lit(False))
    of = t.spark.read.parquet(f"{inbox}/1").schema
    capture = ChangeCapture(t.spark, inbox, path, of)
    capture.run()
    capture.acknowledge(capture.batches())
    write(several.withColumn("leave_days", F.lit(99)), 2, F.lit(False))
    capture.run()
    write(several.withColumn("leave_days", F.lit(98)), 3, F.lit(False))
    write(daily, 4, F.col("pegawai_id") % 17 == 0)
    again = ChangeCapture(t.spark, inbox, path, of)
    again.run()
    return again.pending().select(*KEYS, "operation", F.get_json_object("payload", "$.leave_days").cast("int").alias("leave_days"))


QUERIES = {
    "capture_stream": (
        _captured,
        """SELECT pegawai_id, tanggal, CASE WHEN pegawai_id % 17 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS operation, CASE
            WHEN pegawai_id % 17 <> 0 THEN leave_days END AS leave_days FROM {daily}
           WHERE CASE WHEN pegawai_id % 17 = 0 THEN pegawai_id % 11 <> 0 ELSE pegawai_id % 11 = 0 OR pegawai_id % 13 = 0 END""",
    ),
}
