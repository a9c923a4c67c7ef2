"""The delivery stream: order, replays, faults and late changes, on a small daily table."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.operators.incremental import KEYS, capture_changes
from rollcall.streaming.delivery import Consumer, DeliveryError, Outbox

STREAM = "0123456789abcdef" * 2
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def daily(spark, rows):
    df = spark.createDataFrame(rows, "pegawai_id INT, tanggal DATE, dep BIGINT, leave_days INT")
    others = [F.lit(0).alias(m) for m in R.MEASURES if m != "leave_days"]
    return df.select("*", *others, F.lit(False).alias("perlu_review"), F.lit(True).alias("is_date_final"), F.lit(dt.datetime(2024, 1, 1, 8, 0, 0, 123456)).alias("at"))


def to_fact(d):
    return d.withColumnRenamed("dep", "departemen_key")


def pair(spark, first):
    root = tempfile.mkdtemp(prefix="spark-")
    outbox = Outbox(spark, f"{root}/outbox", STREAM)
    outbox.bootstrap(first)
    return outbox, Consumer(spark, f"{root}/mart", outbox.path, first.schema, to_fact)


def content(consumer):
    facts = sorted(tuple(r) for r in consumer.fact().select(*KEYS, "departemen_key", "leave_days").collect())
    sums = sorted(tuple(r) for r in consumer.aggregates().select("tanggal", "departemen_key", "leave_days", "fact_rows").collect())
    return facts, sums


def test_stream_applies_in_order_and_keeps_other_dates(spark):
    first = daily(spark, [(1, D1, 7, 0), (2, D1, 8, 1), (1, D2, 7, 0)])
    outbox, consumer = pair(spark, first)
    consumer.run(outbox)
    second = daily(spark, [(1, D1, 7, 1), (1, D2, 7, 0), (3, D2, 8, 1)])
    outbox.deliver(capture_changes(first, second))
    third = daily(spark, [(1, D1, 9, 1), (1, D2, 7, 0), (3, D2, 8, 1)])
    outbox.deliver(capture_changes(second, third))
    consumer.run(outbox)
    facts, sums = content(consumer)
    assert facts == [(1, D1, 9, 1), (1, D2, 7, 0), (3, D2, 8, 1)]
    assert sums == [(D1, 9, 1, 1), (D2, 7, 0, 1), (D2, 8, 1, 1)]
    assert {r["at"] for r in consumer.fact().select("at").collect()} == {dt.datetime(2024, 1, 1, 8, 0, 0, 123456)}
    assert sorted(r["sequence"] for r in outbox.acknowledged().collect()) == [1, 2, 3, 4]
    # A date whose rows all go leaves nothing behind.
    outbox.deliver(capture_changes(third, third.where(F.col("tanggal") == D2)))
    consumer.run(outbox)
    assert content(consumer)[0] == [(1, D2, 7, 0), (3, D2, 8, 1)]


def test_replays_gaps_and_faults(spark):
    outbox, consumer = pair(spark, daily(spark, [(1, D1, 7, 0), (1, D2, 7, 0)]))
    one, two = (r.asDict() for r in outbox.envelopes().orderBy("sequence").collect())
    with pytest.raises(DeliveryError, match="first delivery"):
        consumer.apply(two)
    receipt = consumer.apply(one)
    assert consumer.apply(one) == receipt
    with pytest.raises(DeliveryError, match="another payload"):
        consumer.apply(one | {"digest": "x"})
    with pytest.raises(DeliveryError, match="gap"):
        consumer.apply(two | {"sequence": 3})
    with pytest.raises(DeliveryError, match="gap"):
        consumer.apply(two | {"stream_id": "f" * 32})
    with pytest.raises(DeliveryError, match="envelope"):
        consumer.apply(two | {"kind": "OTHER"})
    with pytest.raises(DeliveryError, match="match"):
        consumer.apply(two | {"n_items": 5})
    with pytest.raises(DeliveryError, match="not committed"):
        consumer.confirm(receipt[0] | {"sequence": 2})
    with pytest.raises(DeliveryError, match="out of order"):
        outbox.acknowledge(receipt[0] | {"sequence": 2})
    assert outbox.acknowledge(*receipt) == ["ACKNOWLEDGED"]
    assert outbox.acknowledge(*receipt) == ["ALREADY_ACKNOWLEDGED"]
    with pytest.raises(DeliveryError, match="prepared already"):
        outbox.bootstrap(daily(spark, []))


def test_bad_items(spark):
    outbox, consumer = pair(spark, daily(spark, [(1, D1, 7, 0)]))
    consumer.run(outbox)
    before = content(consumer)
    schema = "pegawai_id INT, tanggal DATE, operation STRING, payload STRING"
    payload = '{"pegawai_id":1,"tanggal":"2024-01-01"}'
    for rows, message in (
        ([(2, D1, "UPSERT", payload)], "another key"), ([(1, D1, "UPSERT", None)], "invalid item"), ([(1, D1, "DELETE", payload)], "invalid item"),
        ([(None, D1, "DELETE", None)], "invalid item"), ([(1, D1, "DELETE", None), (1, D1, "UPSERT", payload)], "repeated key"),
    ):
        bad = Outbox(spark, f"{tempfile.mkdtemp(prefix='spark-')}/o", STREAM)
        bad.bootstrap(daily(spark, [(1, D1, 7, 0)]))
        n = bad.deliver(spark.createDataFrame(rows, schema))
        consumer.outbox = bad.path
        e = bad.envelopes().where(F.col("sequence") == n).first().asDict()
        with pytest.raises(DeliveryError, match=message):
            consumer.apply(e)
    assert content(consumer) == before


def test_empty_bootstrap(spark):
    outbox, consumer = pair(spark, daily(spark, []))
    consumer.run(outbox)
    assert content(consumer) == ([], [])
    assert [r["status"] for r in consumer.receipts().collect()] == ["APPLIED"]
