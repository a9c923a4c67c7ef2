"""Incremental upkeep: manifests, change detection, affected keys, capture and application of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.operators import curated, mart
from rollcall.sources.scratch import written

KEYS = ["pegawai_id", "tanggal"]
#: Payloads keep nulls and microseconds.
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def manifest_build(batches: DataFrame) -> DataFrame:
    """``batch_id, entity, operation, source_id``, distinct, from batches that list ids by entity: ``batch_id, entity, upserts, deletes`` (arrays).

    An id that a batch both upserts and deletes is deleted; null ids and lists name nothing.
    """
    ids = lambda c, op: batches.select("batch_id", "entity", F.lit(op).alias("operation"), F.explode(c).alias("source_id"))
    rows = ids("upserts", "UPSERT").unionByName(ids("deletes", "DELETE")).where("source_id is not null")
    return rows.groupBy("batch_id", "entity", "source_id").agg(F.min("operation").alias("operation"))


def manifest_check(items: DataFrame, raw: DataFrame) -> DataFrame:
    """Violations: an UPSERT whose id raw lacks, a DELETE whose id raw has."""
    here = raw.select(F.col("id").alias("source_id"), F.lit(True).alias("here"))
    both = items.join(here, "source_id", "left")
    bad = ((F.col("operation") == "UPSERT") & F.col("here").isNull()) | ((F.col("operation") == "DELETE") & F.col("here").isNotNull())
    return both.where(bad).drop("here")


def changed_rows(new: DataFrame, stored: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Keys of new rows that are not stored alike; ``ignore`` columns don't count."""
    cols = [c for c in new.columns if c != key and c not in ignore]
    old = stored.select(key, F.struct(*cols).alias("_old"), F.lit(True).alias("_here"))
    both = new.join(old, key, "left")
    return both.where(F.col("_here").isNull() | ~F.struct(*cols).eqNullSafe(F.col("_old"))).select(key)


def affected_keys(*sides: DataFrame) -> DataFrame:
    """Distinct employee-dates of old and new rows; rows without a reporting date count by calendar date."""
    out = None
    for s in sides:
        day = F.coalesce("tanggal", "tanggal_event") if "tanggal_event" in s.columns else F.col("tanggal")
        k = s.select("pegawai_id", day.alias("tanggal")).where("pegawai_id is not null and tanggal is not null")
        out = k if out is None else out.union(k)
    return out.distinct()


def capture_changes(old: DataFrame, new: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """``pegawai_id, tanggal, operation, payload``: UPSERT with the new row, its keys too, DELETE without."""
    cmp = [c for c in new.columns if c not in KEYS and c not in ignore]
    n = new.select(*KEYS, F.struct(*cmp).alias("_n"), F.struct(*new.columns).alias("_row"))
    o = old.select(*KEYS, F.struct(*cmp).alias("_o"))
    both = n.join(o, KEYS, "full").where(~F.col("_n").eqNullSafe(F.col("_o")))
    gone = F.col("_row").isNull()  # only changed rows are written as JSON
    return both.select(*KEYS, F.when(gone, "DELETE").otherwise("UPSERT").alias("operation"), F.when(~gone, F.to_json("_row", JSON)).alias("payload"))


def upsert_changed(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Target with new rows in place of those with the same keys."""
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def recompute_affected(keys: DataFrame, population: DataFrame, events: DataFrame, leave_days: DataFrame, daily: DataFrame) -> DataFrame:
    """Daily records with the affected ones computed anew; keys that nothing supports any more vanish."""
    mine = lambda df, day="tanggal": df.join(keys.withColumnRenamed("tanggal", day), ["pegawai_id", day], "left_semi")
    fresh = curated.unified_daily(mine(population), mine(events, "tanggal_event"), curated.leave_daily(mine(leave_days)))
    return daily.join(keys, KEYS, "left_anti").unionByName(fresh)


def leave_fingerprint(leaves: DataFrame) -> DataFrame:
    cols = [c for c in leaves.columns if c != "perizinan_id"]
    return leaves.select("perizinan_id", F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256).alias("fingerprint"))


def changed_leaves(leaves: DataFrame, state: DataFrame) -> DataFrame:
    return changed_rows(leave_fingerprint(leaves), state, "perizinan_id")


def row_change_audit(old: DataFrame, new: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Action, old image and changed fields as maps of texts."""
    cols = [c for c in new.columns if c != key and c not in ignore]
    image = lambda df, name: df.select(key, F.map_from_arrays(F.array(*map(F.lit, cols)), F.array(*(F.col(c).cast("string") for c in cols))).alias(name))
    both = image(old, "row_data").join(image(new, "_new"), key, "full")
    changed = F.map_filter("_new", lambda k, v: ~v.eqNullSafe(F.col("row_data")[k]))
    action = F.when(F.col("row_data").isNull(), "I").when(F.col("_new").isNull(), "D").otherwise("U")
    out = both.select(key, action.alias("action"), "row_data", F.when(action == "U", changed).alias("changed_fields"))
    return out.where((F.col("action") != "U") | (F.size("changed_fields") > 0))


def apply_delivery(fact: DataFrame, items: DataFrame, candidates: DataFrame, agg: DataFrame) -> dict[str, DataFrame]:
    """One delivery onto the fact: changed rows, new fact, dirty partitions and rebuilt aggregates.

    ``items`` has the keys and operation; ``candidates`` the rows of its upserts, as facts.
    """
    deleted = items.where("operation = 'DELETE'").select(*KEYS)
    cols = [c for c in fact.columns if c not in KEYS]
    old = fact.select(*KEYS, F.struct(*cols).alias("_old"))
    changed = candidates.join(old, KEYS, "left").where(~F.struct(*cols).eqNullSafe(F.col("_old"))).select(*fact.columns)
    dirty = mart.dirty_partitions(fact, changed, deleted)
    after = upsert_changed(fact.join(deleted, KEYS, "left_anti"), changed, KEYS)
    return {"changed": changed, "fact": after, "dirty": dirty, "agg": mart.rebuild_partitions(after, dirty, agg)}


def mutation_guard(batches: DataFrame, daily: DataFrame, master: DataFrame) -> DataFrame:
    """What forbids each batch (``batch_id, snapshot_date, today``): null, or the first reason.

    A population snapshot must be of today, its date must not be closed and the employee master must
    have rows. A batch without a snapshot is always allowed.
    """
    closed = daily.where("is_date_final").select(F.col("tanggal").alias("snapshot_date"), F.lit(True).alias("_closed")).distinct()
    empty = master.limit(1).agg((F.count("*") == 0).alias("_empty"))  # one row
    b = batches.join(closed, "snapshot_date", "left").crossJoin(F.broadcast(empty))
    day = F.col("snapshot_date")
    reason = F.when(day.isNull(), None).when(~day.eqNullSafe(F.col("today")), "SNAPSHOT_NOT_TODAY").when(R.true("_closed"), "DATE_CLOSED").when(F.col("_empty"), "EMPTY_MASTER")
    return b.select("batch_id", day, reason.alias("refused"))


def refuse(guarded: DataFrame) -> None:
    """Raise for the first refused batch; call before anything of it is written."""
    row = guarded.where("refused is not null").orderBy("batch_id").first()
    if row:
        raise ValueError(f"batch {row['batch_id']}: {row['refused']}")


def late_correction(late: DataFrame, population: DataFrame, events: DataFrame, leave_days: DataFrame, daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Late events, enriched, count on the date on which they happened: the new daily records, and the dates and departments to be summed anew.

    There is no watermark: an event of any age is taken.
    """
    keys = affected_keys(late)
    after = recompute_affected(keys, population, events.unionByName(late), leave_days, daily)
    dirty = after.join(keys, KEYS, "left_semi").select("tanggal", "departemen_id").union(daily.join(keys, KEYS, "left_semi").select("tanggal", "departemen_id")).distinct()
    return after, dirty


def tolerant_payload(payloads: DataFrame, col: str, fields: str, defaults: dict[str, str]) -> DataFrame:
    """Payloads of any age as columns: fields that one lacks are null, or their default."""
    names = [f.split()[0] for f in fields.split(", ")]
    d = payloads.withColumn("_d", F.from_json(col, fields, JSON))
    value = lambda n: F.coalesce(F.col("_d")[n], F.lit(defaults[n])) if n in defaults else F.col("_d")[n]
    return d.select(*(c for c in payloads.columns if c != col and c not in names), *(value(n).alias(n) for n in names))


def apply_in_order(outbox: DataFrame, keys: list[str]) -> DataFrame:
    """The state after all batches: each key's payload of the highest sequence, without deleted ones, and how many versions were queued.

    ``outbox`` has the keys, ``sequence, operation, payload``; every batch keeps the payload that it was made with.
    """
    last = outbox.groupBy(*keys).agg(F.count("*").alias("versions"), F.max_by(F.struct("operation", "payload"), "sequence").alias("_last"))
    return last.where("_last.operation = 'UPSERT'").select(*keys, "versions", F.col("_last.payload").alias("payload"))


def _old_daily(t) -> DataFrame:
    """An older state: without some employees, and with other leave flags for some."""
    return t.daily.where("pegawai_id % 11 <> 0").withColumn("leave_days", F.when(F.col("pegawai_id") % 13 == 0, 7).otherwise(F.col("leave_days")))


def _changes(t) -> DataFrame:
    return capture_changes(_old_daily(t), t.daily.where("pegawai_id % 17 <> 0")).select(*KEYS, "operation")


def _listed(t) -> DataFrame:
    """Batches that list leaves and events; ids occur twice, and deleted ones among the upserts too."""
    listed = lambda df, entity, batches, gone: df.select((F.col("id") % batches).cast("int").alias("batch_id"), F.lit(entity).alias("entity"),
        F.array("id", "id", F.lit(None)).alias("upserts"),
                                                         F.when(gone, F.array("id")).alias("deletes"))
    return listed(t.t_perizinan.select(F.col("id").cast("long").alias("id")), "LEAVE", 7,
        F.col("id") % 5 == 0).unionByName(listed(t.t_checkinout.select(F.col("id").cast("long").alias("id")), "EVENT", 11, F.col("id") % 9 == 2))


def _items(t) -> DataFrame:
    op = F.when(F.col("id") % 5 == 0, "DELETE").otherwise("UPSERT")
    return t.t_perizinan.select(F.col("id").alias("source_id"), op.alias("operation"))


def _batches(t) -> DataFrame:
    day = F.dayofmonth("tanggal")
    today = F.when(day % 3 == 0, F.date_add("tanggal", 1)).otherwise(F.col("tanggal"))
    return t.dates.select(R.calendar_key("tanggal").alias("batch_id"), F.when(day % 7 > 0, F.col("tanggal")).alias("snapshot_date"), today.alias("today"))


def _closed_days(t) -> DataFrame:
    return t.date_state.select("tanggal", F.col("is_closed").alias("is_date_final"))


def _late(t, what: int) -> DataFrame:
    """The events of some employees come after the daily records were made."""
    late, early = t.ev.where("event_id % 50 = 3"), t.ev.where("event_id % 50 <> 3")
    before = curated.unified_daily(t.pop, early, t.lvsum)
    return late_correction(late, t.pop, early, t.lvday, before)[what]


_PAYLOAD = "pegawai_id INT, tanggal DATE, lateness_status STRING, leave_days INT, note STRING"


def _aged(t) -> DataFrame:
    """Payloads of which those of even employees were made before the status was added."""
    new, old = F.struct("pegawai_id", "tanggal", "lateness_status", "leave_days"), F.struct("pegawai_id", "tanggal", "leave_days")
    return t.daily.select(F.when(F.col("pegawai_id") % 2 == 0, F.to_json(old, JSON)).otherwise(F.to_json(new, JSON)).alias("payload"))


def _outbox(t) -> DataFrame:
    """Three batches: all records, a later version of some, and the deletion of others."""
    row = lambda n, op, payload, df: df.select(*KEYS, F.lit(n).alias("sequence"), F.lit(op).alias("operation"), payload.cast("string").alias("payload"))
    first = row(1, "UPSERT", F.col("leave_days"), t.daily)
    second = row(2, "UPSERT", F.col("leave_days") + 10, t.daily.where("pegawai_id % 3 = 0"))
    return first.unionByName(second).unionByName(row(3, "DELETE", F.lit(None), t.daily.where("pegawai_id % 5 = 0")))


_LATE_KEYS = "(SELECT pegawai_id, coalesce(tanggal, tanggal_event) AS tanggal FROM {ev} WHERE event_id % 50 = 3 AND pegawai_id IS NOT NULL)"


def _delivered(t, what: str) -> DataFrame:
    fact = written(t.fact, "fact")  # it stands in every part of the delivery, and would be computed for each
    base = fact.where("pegawai_id % 11 <> 0")
    items = fact.select(*KEYS, F.when(F.col("pegawai_id") % 17 == 0, "DELETE").otherwise("UPSERT").alias("operation"))
    return apply_delivery(base, items, fact.where("pegawai_id % 17 <> 0"), mart.department_day_sum(base))[what]


_DIRTY = "SELECT DISTINCT tanggal, departemen_key FROM {fact} WHERE pegawai_id % 11 = 0 AND pegawai_id % 17 <> 0 OR pegawai_id % 17 = 0 AND pegawai_id % 11 <> 0"

QUERIES = {
    "mutation_guard": (
        lambda t: mutation_guard(_batches(t), _closed_days(t), t.m_pegawai).withColumn("master",
            F.lit("full")).unionByName(mutation_guard(_batches(t), _closed_days(t), t.m_pegawai.where("id < 0")).withColumn("master", F.lit("empty"))),
        """SELECT batch_id, snapshot_date, master, CASE WHEN snapshot_date IS NULL THEN NULL WHEN day % 3 = 0 THEN 'SNAPSHOT_NOT_TODAY'
            WHEN coalesce(is_closed, false) THEN 'DATE_CLOSED' WHEN master = 'empty' THEN 'EMPTY_MASTER' END AS refused
           FROM (SELECT CAST(strftime(tanggal, '%Y%m%d') AS INT) AS batch_id, CASE WHEN day(tanggal) % 7 > 0 THEN tanggal END AS snapshot_date,
               day(tanggal) AS day, is_closed, unnest(['full', 'empty']) AS master
                 FROM {dates} LEFT JOIN {date_state} USING (tanggal))""",
    ),
    "late_correction": (lambda t: _late(t, 0), "SELECT * FROM {daily}"),
    "late_correction_partitions": (lambda t: _late(t, 1), f"SELECT DISTINCT d.tanggal, d.departemen_id FROM {{daily}} d WHERE (d.pegawai_id, d.tanggal) IN {_LATE_KEYS}"),
    "schema_tolerant_payload": (
        lambda t: tolerant_payload(_aged(t), "payload", _PAYLOAD, {"lateness_status": "UNKNOWN"}),
        (
            "SELECT pegawai_id, tanggal, CASE WHEN pegawai_id % 2 = 0 THEN 'UNKNOWN' ELSE lateness_status END AS lateness_status, "
            "leave_days, CAST(NULL AS VARCHAR) AS note FROM {daily}"
        ),
    ),
    "latest_payload_per_batch": (
        lambda t: apply_in_order(_outbox(t), KEYS),
        """SELECT pegawai_id, tanggal, CASE WHEN pegawai_id % 3 = 0 THEN 2 ELSE 1 END AS versions, CAST(leave_days + CASE
            WHEN pegawai_id % 3 = 0 THEN 10 ELSE 0 END AS VARCHAR) AS payload
           FROM {daily} WHERE pegawai_id % 5 <> 0""",
    ),
    "manifest_build": (
        lambda t: manifest_build(_listed(t)),
        """SELECT DISTINCT batch_id, entity, id AS source_id, CASE WHEN gone THEN 'DELETE' ELSE 'UPSERT' END AS operation FROM (
             SELECT CAST(id % 7 AS INT) AS batch_id, 'LEAVE' AS entity, id, id % 5 = 0 AS gone FROM {t_perizinan} UNION ALL
                 SELECT CAST(id % 11 AS INT), 'EVENT', id, id % 9 = 2 FROM {t_checkinout})""",
    ),
    "manifest_check": (lambda t: manifest_check(_items(t), t.t_perizinan.where("id % 3 <> 0")),
        "SELECT id AS source_id, CASE WHEN id % 5 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS operation FROM {t_perizinan} WHERE (id % 5 = 0) = (id % 3 <> 0)"),
    "changed_rows": (
        lambda t: changed_rows(t.lv, t.lv.where("perizinan_id % 4 <> 0").withColumn("tipe_ijin", F.when(F.col("perizinan_id") % 7 == 0,
            0).otherwise(F.col("tipe_ijin"))), "perizinan_id"),
        "SELECT perizinan_id FROM {lv} WHERE perizinan_id % 4 = 0 OR perizinan_id % 7 = 0",
    ),
    "affected_keys": (lambda t: affected_keys(t.ev, t.lvday),
        "SELECT pegawai_id, coalesce(tanggal, tanggal_event) AS tanggal FROM {ev} WHERE pegawai_id IS NOT NULL UNION SELECT pegawai_id, tanggal FROM {lvday}"),
    "capture_changes": (
        _changes,
        """SELECT pegawai_id, tanggal, CASE WHEN pegawai_id % 17 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS operation FROM {daily}
           WHERE CASE WHEN pegawai_id % 17 = 0 THEN pegawai_id % 11 <> 0 ELSE pegawai_id % 11 = 0 OR pegawai_id % 13 = 0 END""",
    ),
    "upsert_changed": (lambda t: upsert_changed(_old_daily(t), t.daily.where("pegawai_id % 13 = 0"), KEYS).select(*KEYS, "leave_days"),
        "SELECT pegawai_id, tanggal, leave_days FROM {daily} WHERE pegawai_id % 11 <> 0 OR pegawai_id % 13 = 0"),
    "recompute_affected": (
        lambda t: recompute_affected(written(affected_keys(t.ev.where("pegawai_id % 3 = 0"), t.pop.where("pegawai_id % 3 = 0"),
            t.lvday.where("pegawai_id % 3 = 0")), "affected"), t.pop, t.ev, t.lvday, t.daily.where("pegawai_id % 3 <> 0 or pegawai_id % 2 = 0")),
        "SELECT * FROM {daily}",
    ),
    "leave_fingerprint": (lambda t: changed_leaves(t.lv, leave_fingerprint(t.lv.where("perizinan_id % 4 <> 0"))), "SELECT perizinan_id FROM {lv} WHERE perizinan_id % 4 = 0"),
    "population_diff": (lambda t: changed_rows(t.pop.select(F.concat_ws("/", *KEYS).alias("k"), "status_sumber"),
        t.pop.where("pegawai_id % 4 <> 0").select(F.concat_ws("/", *KEYS).alias("k"), "status_sumber"), "k"),
            "SELECT pegawai_id || '/' || tanggal AS k FROM {pop} WHERE pegawai_id % 4 = 0"),
    "dirty_partitions": (lambda t: _delivered(t, "dirty"), _DIRTY),
    "rebuild_partitions": (lambda t: _delivered(t, "agg").select("tanggal", "departemen_key", *R.MEASURES[:3], "fact_rows"),
        "SELECT tanggal, departemen_key, " + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in R.MEASURES[:3]) + ", count(*) AS fact_rows FROM {fact} WHERE pegawai_id % 17 <> 0 GROUP BY ALL"),
    "delivery_apply": (lambda t: _delivered(t, "fact").select(*KEYS, "departemen_key", "leave_days"),
        "SELECT pegawai_id, tanggal, departemen_key, leave_days FROM {fact} WHERE pegawai_id % 17 <> 0"),
    "reset_date_state": (
        lambda t: mart.reset_date_state(t.date_state, t.fact.where("pegawai_id = 21").select("tanggal")),
        """SELECT coalesce(s.tanggal, d.tanggal) AS tanggal, coalesce(population_complete, false) AND d.tanggal IS NULL AS population_complete,
            coalesce(curated_delivery_complete, false) AND d.tanggal IS NULL AS curated_delivery_complete,
           coalesce(is_closed, false) AND d.tanggal IS NULL AS is_closed FROM {date_state} s FULL JOIN (SELECT DISTINCT tanggal FROM {fact}
               WHERE pegawai_id = 21) d ON d.tanggal = s.tanggal""",
    ),
    "batch_result": (lambda t: _changes(t).groupBy("operation").agg(F.count("*").alias("n")),
        (
            "SELECT 'DELETE' AS operation, count(*) AS n FROM {daily} WHERE pegawai_id % 17 = 0 AND pegawai_id % 11 <> 0 UNION ALL "
            "SELECT 'UPSERT', count(*) FROM {daily} WHERE pegawai_id % 17 <> 0 AND (pegawai_id % 11 = 0 OR pegawai_id % 13 = 0)"
        )),
    "row_change_audit": (
        lambda t: row_change_audit(t.m_pegawai.where("id % 5 <> 0"),
            t.m_pegawai.where("id % 7 <> 0").withColumn("status", F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("status"))), "id", ("created_at",)).select(
            "id", "action", F.to_json("row_data").alias("old_image"), F.to_json("changed_fields").alias("changed_fields")),
        """SELECT id, CASE WHEN id % 5 = 0 THEN 'I' WHEN id % 7 = 0 THEN 'D' ELSE 'U' END AS action,
             CASE WHEN id % 5 <> 0 THEN CAST(json_object('nama', nama, 'departemen', CAST(departemen AS VARCHAR), 'status', CAST(status AS VARCHAR)) AS VARCHAR) END AS old_image,
             CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN '{"status":"8"}' END AS changed_fields
           FROM {m_pegawai} WHERE CASE WHEN id % 5 = 0 AND id % 7 = 0 THEN false WHEN id % 5 = 0 OR id % 7 = 0 THEN true ELSE id % 3 = 0 END""",
    ),
}
