"""From events, leave requests and masters to one record for each employee and date.

Each function maps DataFrames to a DataFrame and leaves the physical plan to Spark: masters are small
and are broadcast by Spark when their size says so; everything keyed by employee and date shuffles
on that pair, so consecutive aggregations and joins share one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import rules as R

KEYS = ["pegawai_id", "tanggal"]


def unresolved(employee: Column, at: Column, checktype: Column, start: Column, end: Column) -> Column:
    """No identity or time, or a check-out whose schedule isn't known to end on the same day."""
    open_schedule = start.isNull() | end.isNull() | (end <= start)
    return employee.isNull() | at.isNull() | R.true((checktype == 2) & open_schedule)


def event_enrich(events: DataFrame, jadwal: DataFrame, shift: DataFrame) -> DataFrame:
    """Events with schedule, shift, reporting date, review reasons and window status. Orphans are kept.

    Times come from the event's own snapshot; the master fills in only for the date's attribution.
    Schedules and shifts grow with the data, so they are never broadcast, whatever their files' sizes say.
    """
    j = jadwal.select(F.col("id").alias("j_id"), "jenis", F.col("jam_masuk").alias("j_masuk"), F.col("jam_keluar").alias("j_keluar"))
    s = shift.select(F.col("id").alias("s_id"), F.col("nama").alias("shift_name"), F.col("status").alias("shift_active"))
    e = events.join(j.hint("shuffle_hash"), events["jadwal_id"] == j["j_id"], "left").join(s.hint("shuffle_hash"), F.col("jenis") == F.col("s_id"), "left")
    start, end = F.coalesce("jam_masuk", "j_masuk"), F.coalesce("jam_keluar", "j_keluar")
    e = e.withColumn("unresolved", unresolved(F.col("pegawai_id"), F.col("created_at"), F.col("checktype"), start, end))
    u, day = F.col("unresolved"), F.to_date("created_at")
    missing, mismatch = F.col("j_id").isNull() | F.col("s_id").isNull(), ~F.col("work_code").eqNullSafe(F.col("jenis"))
    identity = F.col("pegawai_id").isNull() | F.col("created_at").isNull()
    return e.select(
        F.col("id").alias("event_id"), "pegawai_id", F.col("created_at").alias("waktu_event"), "jam", "checktype", "jadwal_id", "work_code",
        "jam_masuk", "jam_masuk_awal", "jam_keluar", "jam_keluar_akhir", "is_manual", F.col("jenis").alias("shift_id"), "shift_name", "shift_active",
        day.alias("tanggal_event"), F.when(~u, day).alias("tanggal"),
        F.when(u, "UNRESOLVED").otherwise("PROVISIONAL").alias("date_status"),
        F.when(identity, "MISSING_IDENTITY_OR_TIME").when(u, "CHECKOUT_OVERNIGHT_OR_SCHEDULE_UNKNOWN_PENDING_POLICY")
        .otherwise("CALENDAR_DATE_PENDING_DAY_CLOSE").alias("date_reason"),
        F.when(~u, R.POLICY).alias("date_policy"),
        (u | missing | mismatch).alias("perlu_review"),
        R.reasons((u, "DATE_UNRESOLVED"), (missing, "SCHEDULE_REFERENCE_MISSING"), (mismatch, "WORK_CODE_MISMATCH")).alias("alasan_review"),
        F.when(F.col("checktype") == 1, R.checkin_window("jam", "jam_masuk_awal", "jam_masuk")).alias("checkin_window"),
        F.when(F.col("checktype") == 2, R.checkout_window("jam", "jam_keluar", "jam_keluar_akhir")).alias("checkout_window"),
    )


def population_snapshot(pegawai: DataFrame, departemen: DataFrame, dates: DataFrame) -> DataFrame:
    """Employees x reporting dates with active flag. ``dates`` has one row per ``tanggal``, a calendar.

    Employees are dealt out before they are multiplied: the master's file may be read by a single task.
    """
    status = F.col("status")
    active = F.lit(None).cast("boolean")
    for code, flag in R.ACTIVE_STATUS.items():
        active = F.when(status == code, flag).otherwise(active)
    d = departemen.select(F.col("id").alias("d_id"))
    p = pegawai.join(d, pegawai["departemen"] == d["d_id"], "left").withColumn("active", active)
    unknown, unmapped = F.col("active").isNull(), F.col("d_id").isNull()
    p = p.select(
        F.col("id").alias("pegawai_id"), F.col("departemen").alias("departemen_id"), F.col("status").alias("status_sumber"),
        F.col("active").alias("is_employee_active"), F.lit("EXTRACTION_SNAPSHOT").alias("population_basis"), (unknown | unmapped).alias("perlu_review"),
        R.reasons((unknown, "UNKNOWN_ACTIVE_STATUS"), (unmapped, "DEPARTMENT_UNMAPPED")).alias("alasan_review"),
    )
    return p.repartition("pegawai_id").crossJoin(F.broadcast(dates.select("tanggal")))


def leave_validate(leaves: DataFrame, users: DataFrame, jenis: DataFrame, tipe: DataFrame) -> DataFrame:
    """Leave requests with references, review reasons, and what they excuse."""
    u = users.select(F.col("id").alias("u_id"), F.col("pegawai_id").alias("u_pegawai"))
    j = jenis.select(F.col("id").alias("k_id"), F.col("nama").alias("jenis_nama"), "tipe_id")
    t = tipe.select(F.col("id").alias("t_id"), F.col("nama").alias("tipe_nama"))
    r = leaves.join(u, leaves["user_id"] == u["u_id"], "left").join(j, leaves["jenis_ijin"] == j["k_id"], "left").join(t, F.col("tipe_id") == F.col("t_id"), "left")
    kind, known = F.col("tipe_ijin"), R.true(F.col("tipe_ijin").isin(1, 2, 3))
    reason = R.reasons(
        (F.col("pegawai_id").isNull(), "MISSING_EMPLOYEE"),
        (F.col("user_id").isNotNull() & ~F.col("u_pegawai").eqNullSafe(F.col("pegawai_id")), "IDENTITY_MISMATCH"),
        (F.col("tgl_ijin").isNull() | R.true(F.coalesce("tgl_ijin_sampai", "tgl_ijin") < F.col("tgl_ijin")), "INVALID_RANGE"),
        (~known, "UNKNOWN_LEAVE_TRANSACTION_TYPE"),
        (F.col("k_id").isNull() | F.col("t_id").isNull(), "LEAVE_REFERENCE_MISSING"),
    )
    r = r.withColumn("alasan_review", reason).withColumn("is_valid_leave", R.true("approval") & F.col("alasan_review").isNull())
    valid = F.col("is_valid_leave")
    return r.select(
        F.col("id").alias("perizinan_id"), "pegawai_id", "user_id", "tgl_ijin", "tgl_ijin_sampai", "tipe_ijin", "jenis_ijin", "jenis_nama", "tipe_nama", "approval",
        F.when(known, kind == 1).alias("is_full_day"), F.when(known, kind.isin(2, 3)).alias("is_partial_day"), valid.alias("is_valid_leave"),
        (valid & R.true(kind.isin(1, 2))).alias("excuses_checkin"), (valid & R.true(kind.isin(1, 3))).alias("excuses_checkout"),
        F.col("alasan_review").isNotNull().alias("perlu_review"), "alasan_review",
    )


def leave_expand(leaves: DataFrame) -> DataFrame:
    """One row for each day of a leave; a reversed range has none, an open end is one day."""
    last = F.coalesce("tgl_ijin_sampai", "tgl_ijin")
    rows = leaves.where(F.col("pegawai_id").isNotNull() & (F.col("tgl_ijin") <= last))
    return rows.withColumn("tanggal", F.explode(F.sequence("tgl_ijin", last))).drop("tgl_ijin", "tgl_ijin_sampai")


def event_daily(events: DataFrame) -> DataFrame:
    """Summary of an employee's resolved check-ins and check-outs of a date."""
    e = events.where(F.col("checktype").isin(1, 2) & F.col("tanggal").isNotNull())
    came, left = F.col("checktype") == 1, F.col("checktype") == 2
    return e.groupBy(*KEYS).agg(
        F.count_if(came).alias("checkin_event_count"), F.count_if(left).alias("checkout_event_count"),
        F.min(F.when(came, F.col("waktu_event"))).alias("first_checkin_at"), F.max(F.when(left, F.col("waktu_event"))).alias("last_checkout_at"),
        F.bool_or(R.true("is_manual")).alias("has_manual_event"), F.count_distinct("jadwal_id").alias("schedule_count"),
        F.count_distinct("shift_id").alias("shift_count"), F.bool_or("perlu_review").alias("perlu_review"), R.distinct_texts("alasan_review").alias("alasan_review"),
    )


def leave_daily(days: DataFrame) -> DataFrame:
    """Summary of an employee's leave days of a date."""
    v = F.col("is_valid_leave")
    return days.groupBy(*KEYS).agg(
        F.count("*").alias("leave_rows"), F.bool_or(v).alias("has_valid_leave"), F.bool_or(v & R.true("is_full_day")).alias("has_full_day_leave"),
        F.bool_or(v & R.true("is_partial_day")).alias("has_partial_day_leave"), F.bool_or("excuses_checkin").alias("has_excused_checkin"),
        F.bool_or("excuses_checkout").alias("has_excused_checkout"), F.bool_or("perlu_review").alias("perlu_review"), R.distinct_texts("alasan_review").alias("alasan_review"),
    )


def unresolved_daily(events: DataFrame) -> DataFrame:
    """Events without a reporting date, by the date on which they happened."""
    e = events.where(F.col("tanggal").isNull() & F.col("pegawai_id").isNotNull() & F.col("tanggal_event").isNotNull())
    return e.groupBy("pegawai_id", F.col("tanggal_event").alias("tanggal")).agg(F.count("*").alias("unresolved_count"))


def first_shift_event(events: DataFrame) -> DataFrame:
    """The check-in that decides lateness: of shifts not inactive, those of unknown status first, then by
    scheduled start with missing starts first, then by time."""
    e = events.where((F.col("checktype") == 1) & F.col("tanggal").isNotNull() & ~R.false("shift_active"))
    order = Window.partitionBy(*KEYS).orderBy(
        F.col("shift_active").isNull().desc(), F.col("jam_masuk").asc_nulls_first(), F.col("waktu_event").asc_nulls_last(), "event_id"
    )
    return e.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def checkin_shifts(events: DataFrame) -> DataFrame:
    """For each employee and date: whether all check-ins are on inactive shifts, and active shifts by start."""
    e = events.where((F.col("checktype") == 1) & F.col("tanggal").isNotNull())
    active = R.true("shift_active")
    return e.groupBy(*KEYS).agg(
        F.bool_and(R.false("shift_active")).alias("all_inactive"),
        F.collect_set(F.when(active & F.col("shift_id").isNotNull(), F.struct("jam_masuk", "shift_id"))).alias("active_shifts"),
    )


def event_summary(events: DataFrame) -> DataFrame:
    """All that a daily record takes from an employee's events of a date, in one aggregation.

    The date is the calendar date, which is the reporting date of resolved events: so the summary of
    check-ins and check-outs, the unresolved count, the check-in that decides lateness and the active
    shifts come from one scan and one exchange.
    """
    came, left, resolved = F.col("checktype") == 1, F.col("checktype") == 2, F.col("tanggal").isNotNull()
    counted = resolved & F.coalesce(came | left, F.lit(False))
    checked_in, active = F.coalesce(resolved & came, F.lit(False)), R.true("shift_active")
    # Nulls first: of shifts not inactive those of unknown status, then by scheduled start, then by time.
    order = F.struct(F.col("shift_active").isNotNull(), F.col("jam_masuk").isNotNull(), "jam_masuk", "waktu_event", "event_id")
    first = F.struct("event_id", "jadwal_id", "shift_id", "shift_active", "perlu_review", "jam_masuk", "jam_masuk_awal", "jam")
    decides = checked_in & ~R.false("shift_active")
    rows = events.where("pegawai_id is not null and tanggal_event is not null")
    return rows.groupBy("pegawai_id", F.col("tanggal_event").alias("tanggal")).agg(
        F.count_if(checked_in).alias("checkin_event_count"), F.count_if(counted & left).alias("checkout_event_count"),
        F.min(F.when(checked_in, F.col("waktu_event"))).alias("first_checkin_at"),
        F.max(F.when(counted & left, F.col("waktu_event"))).alias("last_checkout_at"),
        F.bool_or(counted & R.true("is_manual")).alias("has_manual_event"), F.bool_or(counted & F.col("perlu_review")).alias("e_review"),
        R.distinct_texts(F.when(counted, F.col("alasan_review"))).alias("e_reason"), F.count_if(counted).alias("e_rows"), F.count_if(~resolved).alias("unresolved_count"),
        F.min_by(F.when(decides, first), F.when(decides, order)).alias("first"), F.count_if(checked_in & ~R.false("shift_active")).alias("not_inactive"),
        F.collect_set(F.when(checked_in & active & F.col("shift_id").isNotNull(), F.struct("jam_masuk", "shift_id"))).alias("active_shifts"),
    )


def lateness(daily: DataFrame) -> DataFrame:
    """Adds lateness status, reason, event and schedule to daily records that have the columns of :func:`event_summary`."""
    f = F.col("first")
    none, start, early = f.isNull(), f["jam_masuk"], f["jam_masuk_awal"]
    ties = F.size(F.filter(F.coalesce("active_shifts", F.array().cast("array<struct<jam_masuk:bigint,shift_id:int>>")), lambda x: x["jam_masuk"].eqNullSafe(start)))
    no_checkin = F.col("checkin_event_count") == 0
    steps = (
        (~R.true("is_employee_active"), "NOT_ASSESSED", "EMPLOYEE_ACTIVE_STATUS_NOT_TRUE"),
        (R.true("has_excused_checkin"), "EXCUSED", "EXCUSED_CHECKIN"),
        (no_checkin, "NOT_ASSESSED", "NO_CHECKIN"),
        (none & (F.col("not_inactive") == 0), "NOT_ASSESSED", "INACTIVE_SHIFT_ONLY"),
        (none, "UNKNOWN", "CHECKIN_NOT_FOUND"),
        (~R.true(f["shift_active"]), "UNKNOWN", "SHIFT_ACTIVE_STATUS_UNKNOWN"),
        (R.true(f["perlu_review"]), "UNKNOWN", "EVENT_REQUIRES_REVIEW"),
        (f["shift_id"].isNull(), "UNKNOWN", "SHIFT_UNRESOLVED"),
        (start.isNull() | early.isNull(), "UNKNOWN", "WINDOW_MISSING"),
        (ties > 1, "UNKNOWN", "FIRST_SHIFT_AMBIGUOUS"),
        (R.true(early > start), "UNKNOWN", "WINDOW_CROSSES_MIDNIGHT_OR_INVALID"),
    )
    status = reason = F
    for rule, s, r in steps:
        status, reason = status.when(rule, s), reason.when(rule, r)
    status = status.otherwise(R.checkin_window(f["jam"], early, start))
    return daily.withColumns({"lateness_status": status, "lateness_reason": reason, "lateness_event_id": f["event_id"], "lateness_schedule_id": f["jadwal_id"]})


def unified_daily(population: DataFrame, events: DataFrame, by_leave: DataFrame) -> DataFrame:
    """One record for each employee and date that any side knows, with lateness and the twelve measures.

    Population and leave are unique by the two keys; events are enriched ones. Events and leave meet first: a full join keeps no
    partitioning, so what comes out of the first one is shuffled again, and that should be the fewer rows.
    """
    p = population.select(*KEYS, "departemen_id", "is_employee_active", "population_basis", F.col("perlu_review").alias("p_review"),
        F.col("alasan_review").alias("p_reason"), F.lit(True).alias("p_here"))
    v = by_leave.withColumnsRenamed({"perlu_review": "l_review", "alasan_review": "l_reason"})
    d = p.join(event_summary(events).join(v, KEYS, "full"), KEYS, "full")
    here, some_open = R.true("p_here"), F.coalesce(F.col("unresolved_count") > 0, F.lit(False))
    d = d.where(here | F.coalesce(F.col("e_rows") > 0, F.lit(False)) | F.col("leave_rows").isNotNull() | some_open)
    unknown = F.col("is_employee_active").isNull()
    flags = {c: R.true(c) for c in ("has_manual_event", "has_valid_leave", "has_full_day_leave", "has_partial_day_leave", "has_excused_checkin", "has_excused_checkout")}
    d = d.withColumns({
        "checkin_event_count": F.coalesce("checkin_event_count", F.lit(0)), "checkout_event_count": F.coalesce("checkout_event_count", F.lit(0)), **flags,
        "perlu_review": ~here | unknown | R.true("p_review") | R.true("e_review") | R.true("l_review") | some_open,
        "alasan_review": R.join_texts("p_reason", "e_reason", "l_reason", F.when(~here, "POPULATION_SNAPSHOT_MISSING"),
            F.when(unknown, "ACTIVE_STATUS_UNKNOWN"), F.when(some_open, "UNRESOLVED_EVENT_ON_CALENDAR_DATE")),
        "is_date_final": F.lit(False), "date_assignment_policy": F.lit(R.POLICY),
    })
    d = lateness(d).withColumns({"has_masuk": F.col("checkin_event_count") > 0, "has_pulang": F.col("checkout_event_count") > 0})
    return d.withColumns(R.measures()).select(
        *KEYS, "departemen_id", "is_employee_active", "population_basis", "checkin_event_count", "checkout_event_count", "first_checkin_at", "last_checkout_at",
        "has_masuk", "has_pulang", *flags, "lateness_status", "lateness_event_id", "lateness_schedule_id", "lateness_reason", *R.MEASURES,
        "perlu_review", "alasan_review", "is_date_final", "date_assignment_policy",
    )
