"""Ordered, idempotent delivery of daily records: an outbox of batches and a streaming consumer.

A delivery is a set of items (``pegawai_id, tanggal, operation, payload``), written as Parquet by its
sequence, and an envelope of one row with stream, sequence, kind, number of items and a digest of them.
The envelope is written after its items, so a stream over the envelopes sees only whole deliveries; items
never pass through the driver. The consumer writes the new content of the dates that a delivery touches
under the delivery's sequence and its receipt last. Readers follow receipts, so a delivery that was
interrupted is invisible, and applying it again gives the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.operators import mart
from rollcall.operators.incremental import JSON, KEYS, upsert_changed
from rollcall.sources.scratch import scratch

CONTRACT = "ATTENDANCE_DAILY_V1"
ITEMS = "pegawai_id INT, tanggal DATE, operation STRING, payload STRING"
ENVELOPE = "contract_version STRING, stream_id STRING, sequence BIGINT, kind STRING, n_items BIGINT, digest STRING"
RECEIPT = "stream_id STRING, sequence BIGINT, n_items BIGINT, digest STRING, status STRING"


class DeliveryError(ValueError):
    """A delivery or receipt that breaks the contract; nothing of it was applied."""


def _digest() -> list:
    """Number of items and a digest that doesn't depend on their order."""
    row = F.xxhash64(F.col("pegawai_id"), F.col("tanggal"), F.coalesce("operation", F.lit("")), F.coalesce("payload", F.lit("")))
    parts = (F.sum(row.cast("decimal(20,0)")), F.bit_xor(row))
    return [F.count("*").alias("n_items"), F.concat_ws("/", *(F.coalesce(p.cast("string"), F.lit("0")) for p in parts)).alias("digest")]


class _Folder:
    """Tables by sequence under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _rows(self, name: str, schema: str | StructType) -> DataFrame:
        """Rows of every sequence; none when nothing was written."""
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{self.path}/{name}")

    def _put(self, name: str, rows: list[dict], schema: str) -> None:
        """Writes rows of a run of sequences as one file, named after the first."""
        df = self.spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
        df.coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}/{rows[0]['sequence']:020d}")


class Outbox(_Folder):
    """Batches of changes in the order they were made. Two versions of a row in two batches stay apart."""

    def __init__(self, spark: SparkSession, path: str, stream_id: str):
        super().__init__(spark, path)
        self.stream_id = stream_id

    def envelopes(self) -> DataFrame:
        return self._rows("envelopes", ENVELOPE)

    def acknowledged(self) -> DataFrame:
        return self._rows("acks", RECEIPT)

    def _last(self) -> int:
        return self.envelopes().agg(F.max("sequence")).first()[0] or 0

    def _envelope(self, sequence: int, kind: str, n_items: int, digest: str) -> dict:
        return {"contract_version": CONTRACT, "stream_id": self.stream_id, "sequence": sequence, "kind": kind, "n_items": n_items, "digest": digest}

    def bootstrap(self, daily: DataFrame) -> int:
        """One batch per date of ``daily``, oldest first; one empty batch when it has no rows. Returns how many.

        All items are written in one job; the driver sees one row per date.
        """
        if self._last():
            raise DeliveryError("bootstrap was prepared already")
        rows = daily.select(*KEYS, F.lit("UPSERT").alias("operation"), F.to_json(F.struct(*daily.columns), JSON).alias("payload"))
        days = [r[0] for r in rows.select("tanggal").distinct().orderBy("tanggal").collect()]
        if not days:
            self._write(rows.where("false"), 1, "BOOTSTRAP")
            return 1
        number = self.spark.createDataFrame([(d, k + 1) for k, d in enumerate(days)], "tanggal DATE, sequence BIGINT")
        rows.join(F.broadcast(number), "tanggal").select("sequence", *KEYS, "operation", "payload").write.mode("overwrite").partitionBy("sequence").parquet(f"{self.path}/items")
        sums = self.spark.read.schema(f"{ITEMS}, sequence BIGINT").parquet(f"{self.path}/items").groupBy("sequence").agg(*_digest())
        rows = [self._envelope(r["sequence"], "BOOTSTRAP", r["n_items"], r["digest"]) for r in sums.orderBy("sequence").collect()]
        self._put("envelopes", rows, ENVELOPE)
        return len(days)

    def deliver(self, changes: DataFrame) -> int:
        """A batch of captured changes; returns its sequence."""
        last = self._last()
        if not last:
            raise DeliveryError("prepare the bootstrap before delivering changes")
        self._write(changes.select(*KEYS, "operation", "payload"), last + 1, "DELTA")
        return last + 1

    def _write(self, items: DataFrame, sequence: int, kind: str) -> None:
        path = f"{self.path}/items/sequence={sequence}"
        items.write.mode("overwrite").parquet(path)
        r = self.spark.read.schema(ITEMS).parquet(path).agg(*_digest()).first()
        self._put("envelopes", [self._envelope(sequence, kind, r["n_items"], r["digest"])], ENVELOPE)

    def acknowledge(self, *receipts: dict) -> list[str]:
        """Marks batches as delivered, in sequence only; nothing is marked when one of them can't be."""
        last, done = self._last(), self.acknowledged().agg(F.max("sequence")).first()[0] or 0
        fresh, status = [], []
        for r in receipts:
            if r["stream_id"] != self.stream_id:
                raise DeliveryError("receipt is of another stream")
            if not 1 <= r["sequence"] <= last:
                raise DeliveryError("receipt of an unknown sequence")
            if r["sequence"] > done + 1:
                raise DeliveryError("acknowledgement out of order")
            status.append("ALREADY_ACKNOWLEDGED" if r["sequence"] <= done else "ACKNOWLEDGED")
            if r["sequence"] > done:
                done += 1
                fresh.append(r)
        if fresh:
            self._put("acks", fresh, RECEIPT)
        return status


class Consumer(_Folder):
    """Keeps a fact table and its department-day sums from deliveries.

    ``to_fact`` makes fact rows of daily records (dimension keys); ``daily`` is the schema of the payloads.
    Fields that a payload lacks are null, fields that the schema lacks are ignored.
    """

    def __init__(self, spark: SparkSession, path: str, outbox: str, daily: StructType, to_fact: Callable[[DataFrame], DataFrame]):
        super().__init__(spark, path)
        self.outbox, self.daily, self.to_fact = outbox, daily, to_fact
        self.fact_schema = to_fact(spark.createDataFrame([], daily)).schema

    def receipts(self) -> DataFrame:
        return self._rows("receipts", RECEIPT)

    def _current(self, name: str, schema: StructType) -> DataFrame:
        """Rows of the newest committed content of each date."""
        done = self.receipts().select("sequence")
        touched = self._rows("touched", "sequence BIGINT, tanggal DATE").join(done, "sequence", "left_semi")
        newest = touched.groupBy("tanggal").agg(F.max("sequence").alias("sequence"))
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(StructType([*schema.fields, *StructType.fromDDL("sequence BIGINT").fields])).parquet(f"{self.path}/{name}")
        return rows.join(newest, ["sequence", "tanggal"], "left_semi").select(*schema.names)

    def fact(self) -> DataFrame:
        return self._current("fact", self.fact_schema)

    def aggregates(self) -> DataFrame:
        return self._current("agg", mart.department_day_sum(self.spark.createDataFrame([], self.fact_schema)).schema)

    def _check(self, envelopes: list[dict]) -> dict[int, dict]:
        """Receipts of those of a run of deliveries that were applied before; an error when one may not be applied."""
        receipts, found = self.receipts(), {}
        last = receipts.orderBy(F.desc("sequence")).first()
        at, stream_now = (last["sequence"], last["stream_id"]) if last else (0, None)
        seen = receipts.where(F.col("sequence").isin([e["sequence"] for e in envelopes])).collect() if last else []
        before = {(r["stream_id"], r["sequence"]): r.asDict() for r in seen}
        for e in envelopes:
            stream = e["stream_id"] or ""
            if e["contract_version"] != CONTRACT or e["kind"] not in ("BOOTSTRAP",
                "DELTA") or (e["sequence"] or 0) < 1 or len(stream) != 32 or set(stream) - set("0123456789abcdef"):
                raise DeliveryError("invalid envelope")
            r = before.get((stream, e["sequence"]))
            if r:
                if (r["n_items"], r["digest"]) != (e["n_items"], e["digest"]):
                    raise DeliveryError("replay with another payload")
                found[e["sequence"]] = r
                continue
            if stream_now is None and (e["sequence"] != 1 or e["kind"] != "BOOTSTRAP"):
                raise DeliveryError("the first delivery must be sequence 1 of a bootstrap")
            if stream_now is not None and (stream_now != stream or e["sequence"] != at + 1):
                raise DeliveryError("another stream or a gap in the sequence")
            at, stream_now = e["sequence"], stream
        return found

    def _check_items(self, envelopes: list[dict], items: DataFrame) -> None:
        keys = F.from_json("payload", "pegawai_id INT, tanggal DATE", JSON)
        upsert = F.col("operation") == "UPSERT"
        other = upsert & ~(keys["pegawai_id"].eqNullSafe(F.col("pegawai_id")) & keys["tanggal"].eqNullSafe(F.col("tanggal")))
        shape = F.col("pegawai_id").isNull() | F.col("tanggal").isNull() | ~F.coalesce(F.col("operation").isin("UPSERT", "DELETE"),
            F.lit(False)) | (upsert == F.col("payload").isNull())
        counts = items.groupBy("sequence").agg(F.count_if(shape).alias("shape"), F.count_if(other).alias("other"), F.count_if(~upsert).alias("deletes"), *_digest())
        counts = {r["sequence"]: r for r in counts.collect()}
        for e in envelopes:
            c = counts.get(e["sequence"])
            if (c["n_items"] if c else 0) != e["n_items"] or (c and c["digest"] != e["digest"]):
                raise DeliveryError("items don't match their envelope")
            if c and c["shape"]:
                raise DeliveryError("invalid item")
            if c and c["other"]:
                raise DeliveryError("payload is of another key")
            if c and e["kind"] == "BOOTSTRAP" and c["deletes"]:
                raise DeliveryError("a bootstrap can't delete")
        if items.groupBy("sequence", *KEYS).count().where("count > 1").head(1):
            raise DeliveryError("repeated key")

    def apply(self, *envelopes: dict) -> list[dict]:
        """Applies deliveries in order and returns their receipts; a replay returns the first receipt and changes nothing.

        Deliveries of a bootstrap that touch different dates are applied in one go.
        """
        found = self._check(list(envelopes))
        new = [e for e in envelopes if e["sequence"] not in found]
        run: list[dict] = []
        for e in new:
            if run and (e["kind"] != "BOOTSTRAP" or run[-1]["kind"] != "BOOTSTRAP"):
                found |= self._apply_run(run)
                run = []
            run.append(e)
        if run:
            found |= self._apply_run(run)
        return [found[e["sequence"]] for e in envelopes]

    def _apply_run(self, run: list[dict]) -> dict[int, dict]:
        paths = [f"{self.outbox}/items/sequence={e['sequence']}" for e in run]
        items = self.spark.read.schema(f"{ITEMS}, sequence BIGINT").option("basePath", f"{self.outbox}/items").parquet(*paths)
        try:
            self._check_items(run, items)
            days = items.select("sequence", "tanggal").distinct()
            if len(run) > 1 and days.groupBy("tanggal").count().where("count > 1").head(1):
                raise DeliveryError("two deliveries touch the same date")
        except DeliveryError:
            if len(run) == 1:
                raise
            done = {}
            for e in run:  # those before the faulty one are applied
                done |= self._apply_run([e])
            return done
        names = self.fact_schema.names
        upserts = self.to_fact(items.where("operation = 'UPSERT'").select(F.from_json("payload", self.daily, JSON).alias("d")).select("d.*")).select(*names)
        kept = self.fact().join(days.select("tanggal"), "tanggal", "left_semi").join(items.where("operation = 'DELETE'").select(*KEYS), KEYS, "left_anti")
        after = upsert_changed(kept.select(*names), upserts, KEYS).join(days, "tanggal")
        self._write("fact", after, "sequence", "tanggal")
        written = self.spark.read.schema(StructType([*self.fact_schema.fields, *StructType.fromDDL("sequence BIGINT").fields])).parquet(f"{self.path}/fact")
        written = written.where(F.col("sequence").between(run[0]["sequence"], run[-1]["sequence"]))
        self._write("agg", mart.department_day_sum(written).join(days, "tanggal"), "sequence")
        days.coalesce(1).write.mode("overwrite").json(f"{self.path}/touched/{run[0]['sequence']:020d}")
        receipts = [{"stream_id": e["stream_id"], "sequence": e["sequence"], "n_items": e["n_items"], "digest": e["digest"], "status": "APPLIED"} for e in run]
        self._put("receipts", receipts, RECEIPT)
        return {r["sequence"]: r for r in receipts}

    def _write(self, name: str, rows: DataFrame, *by: str) -> None:
        """Replaces what an interrupted run left of the same sequences; large dates are split, small ones merged, by AQE."""
        rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{name}")

    def confirm(self, *receipts: dict) -> tuple[dict, ...]:
        """The receipts, if all are committed; only then may the outbox be acknowledged."""
        sequences = [r["sequence"] for r in receipts]
        rows = self.receipts().where(F.col("sequence").isin(sequences) & (F.col("status") == "APPLIED")).select("stream_id", "sequence").collect()
        if {(r["stream_id"], r["sequence"]) for r in receipts} - {tuple(r) for r in rows}:
            raise DeliveryError("receipt is not committed")
        return receipts

    def run(self, outbox: Outbox, files_per_trigger: int = 100) -> None:
        """Applies what the outbox holds, in order, and acknowledges it, as a stream over the envelopes.

        The stream's checkpoint remembers which envelopes were seen; a batch that is run again meets its receipts.
        """

        def batch(rows: DataFrame, _: int) -> None:
            envelopes = [e.asDict() for e in rows.orderBy("sequence").collect()]
            if envelopes:
                outbox.acknowledge(*self.confirm(*self.apply(*envelopes)))

        source = self.spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_trigger).json(f"{self.outbox}/envelopes/*")
        query = source.writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()


def stream_fact(t) -> Consumer:
    """The daily records of all but some employees as a bootstrap, then their changes, through a stream."""
    from rollcall.operators.incremental import capture_changes

    path = scratch(t.spark, "delivery")
    t.daily.write.parquet(f"{path}/daily")
    daily = t.spark.read.schema(t.daily.schema).parquet(f"{path}/daily")
    old = daily.where("pegawai_id % 11 <> 0").withColumn("leave_days", F.when(F.col("pegawai_id") % 13 == 0, 7).otherwise(F.col("leave_days")))
    outbox = Outbox(t.spark, f"{path}/outbox", uuid.uuid4().hex)
    outbox.bootstrap(old)
    outbox.deliver(capture_changes(old, daily.where("pegawai_id % 17 <> 0")))
    consumer = Consumer(t.spark, f"{path}/mart", outbox.path, daily.schema, lambda d: mart.fact_daily(d, t.dim_pegawai, t.dim_departemen))
    consumer.run(outbox)
    return consumer


_SUMS = "CAST(sum(checkin_days) AS BIGINT) AS checkin_days, CAST(sum(leave_days) AS BIGINT) AS leave_days, count(*) AS fact_rows"

QUERIES = {
    "delivery_stream_fact": (lambda t: stream_fact(t).fact(), "SELECT * FROM {fact} WHERE pegawai_id % 17 <> 0"),
    "delivery_stream_sums": (
        lambda t: stream_fact(t).aggregates().select("tanggal", "departemen_key", "checkin_days", "leave_days", "fact_rows"),
        f"SELECT tanggal, departemen_key, {_SUMS} FROM {{fact}} WHERE pegawai_id % 17 <> 0 GROUP BY ALL",
    ),
}
