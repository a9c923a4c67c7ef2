"""Joins, windows, set operations and generic aggregates used across the attendance tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import rules as R
from rollcall.sources.scratch import scratch

KEYS = ["pegawai_id", "tanggal"]


def full_outer_diff(new: DataFrame, old: DataFrame, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """Keys that only one side has, or whose other columns differ (nulls are equal)."""
    cols = [c for c in new.columns if c not in keys and c not in ignore]
    n = new.select(*keys, F.struct(*cols).alias("_new"), F.lit(True).alias("_n"))
    o = old.select(*keys, F.struct(*cols).alias("_old"), F.lit(True).alias("_o"))
    both = n.join(o, keys, "full")
    return both.where(F.col("_n").isNull() | F.col("_o").isNull() | ~F.col("_new").eqNullSafe(F.col("_old"))).select(*keys)


def previous_day(days: DataFrame) -> DataFrame:
    """Employee-schedule-days with the check-ins of the day before on the same schedule (null-safe)."""
    b = days.select(F.col("pegawai_id").alias("_p"), F.date_add("tanggal", 1).alias("_d"), F.col("jadwal_id").alias("_j"), F.col("n_in").alias("prev_day_in"))
    hit = F.col("pegawai_id").eqNullSafe(F.col("_p")) & (F.col("tanggal") == F.col("_d")) & F.col("jadwal_id").eqNullSafe(F.col("_j"))
    return days.join(b, hit, "left").drop("_p", "_d", "_j")


def schedule_days(ev: DataFrame) -> DataFrame:
    came, left = F.col("checktype") == 1, F.col("checktype") == 2
    return ev.groupBy("pegawai_id", F.col("tanggal_event").alias("tanggal"), "jadwal_id").agg(F.count_if(came).alias("n_in"), F.count_if(left).alias("n_out"))


def cross_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """``totals`` is one row."""
    return df.crossJoin(F.broadcast(totals))


def unpivot(one: DataFrame, rows: list[tuple[str, list[str]]], names: list[str]) -> DataFrame:
    """Wide counts to rows (metric, names...)."""
    parts = [F.struct(F.lit(label).alias("metric"), *(F.col(c).cast("long").alias(n) for c, n in zip(cols, names, strict=True))) for label, cols in rows]
    return one.select(F.inline(F.array(*parts)))


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key under a total order."""
    return nth_by(df, keys, 1, *order)


def nth_by(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") == n).drop("_n")


def number_within(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def dense_number(df: DataFrame, *order: Column, partitions: int | None = None) -> DataFrame:
    """Numbers from 1 under a total order, without one task for all rows.

    Rows are range-partitioned and numbered within their partition; each partition is shifted by the
    rows before it, one small row for each partition.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "numbered")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written with the number of its partition, so that rows keep it whatever is read or computed again.
    df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    inner = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_size"))
    shift = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(shift.select("_part", "_before")), "_part").withColumn("n", (F.col("_n") + F.col("_before")).cast("long")).drop("_part", "_n", "_before")


def exact_percentile(df: DataFrame, value: Column, q: float, width: float, name: str) -> DataFrame:
    """One row: the interpolated percentile of a column, nulls left out; null without values.

    Values are counted in buckets of ``width`` first, few enough for one task; then only the distinct values of the
    one or two buckets that hold the wanted ranks are ordered. No task holds the values of all rows.
    """
    v = df.select(value.cast("double").alias("v")).where("v is not null").withColumn("b", F.floor(F.col("v") / width))
    upto = Window.orderBy("b")
    h = v.groupBy("b").agg(F.count("*").alias("n")).select("b", (F.sum("n").over(upto) - F.col("n")).alias("before"), F.sum("n").over(upto).alias("upto"))
    h = h.crossJoin(F.broadcast(v.agg((F.lit(q) * (F.count("*") - 1)).alias("at"))))
    holds = lambda rank, a, b: (F.col(a) <= rank) & (rank < F.col(b))
    lo, hi = F.floor("at"), F.ceil("at")
    inside = v.join(F.broadcast(h.where(holds(lo, "before", "upto") | holds(hi, "before", "upto"))), "b").groupBy("b", "v", "before", "at").agg(F.count("*").alias("n"))
    end = F.col("before") + F.sum("n").over(Window.partitionBy("b").orderBy("v"))
    ranked = inside.withColumn("end", end).withColumn("begin", F.col("end") - F.col("n"))
    two = ranked.agg(*(F.max(F.when(holds(rank, "begin", "end"), F.col("v"))).alias(c) for rank, c in ((lo, "x"), (hi, "y"))), F.first("at", True).alias("at"))
    return two.select((F.col("x") + (F.col("at") - F.floor("at")) * (F.col("y") - F.col("x"))).alias(name))


def duplicate_signature(df: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*cols).orderBy(key)))


def previous_event(df: DataFrame, keys: list[str], at: str = "created_at", gap: str = "INTERVAL 1 MINUTE") -> DataFrame:
    """Time of the event before within a key, and whether it is closer than the gap."""
    w = Window.partitionBy(*keys).orderBy(at, "id")
    prev = F.lag(at).over(w)
    near = F.coalesce(F.col(at) - prev < F.expr(gap), F.lit(False))
    return df.withColumns({"prev_at": prev, "near": near}).withColumn("near_later", F.col("near") & (F.col(at) > F.col("prev_at")))


def shift_ties(ev: DataFrame) -> DataFrame:
    """Active shifts that share the scheduled start of the deciding check-in, where there is one."""
    from rollcall.operators.curated import checkin_shifts, first_shift_event

    f = first_shift_event(ev).select(*KEYS, F.col("jam_masuk").alias("_s"))
    x = f.join(checkin_shifts(ev), KEYS)
    ties = F.size(F.filter("active_shifts", lambda s: s["jam_masuk"].eqNullSafe(F.col("_s")))).cast("long")
    return x.select(*KEYS, ties.alias("shift_ties")).where("shift_ties > 0")


def except_both_ways(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other; empty if they are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def month_gaps(months: DataFrame) -> DataFrame:
    """Months between the first and the last that have no row; ``months`` has a date ``month``."""
    m = months.select(F.trunc("month", "month").alias("month")).distinct()
    ends = m.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month")).join(m, "month", "left_anti")


def cross_generate(df: DataFrame, values: list[int], name: str = "side") -> DataFrame:
    return df.withColumn(name, F.explode(F.array(*map(F.lit, values))))


def missing_employee_days(employees: DataFrame, calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """Employees x calendar days without a record; the calendar is one row a day."""
    want = employees.select(F.col("id").alias("pegawai_id")).crossJoin(calendar.select("tanggal"))
    return want.join(fact.select(*KEYS), KEYS, "left_anti")


def usable_schedules(jadwal: DataFrame, shift: DataFrame) -> DataFrame:
    s = shift.where(R.true("status")).select(F.col("id").alias("_s"), "departemen_id")
    ok = (F.col("jam_masuk_awal") <= F.col("jam_masuk")) & (F.col("jam_masuk") < F.col("jam_keluar")) & (F.col("jam_keluar") <= F.col("jam_keluar_akhir")) & (F.col("jam_masuk") <= 22 * 3_600_000_000)
    return jadwal.withColumn("iso_dow", R.weekday("hari")).where(ok & F.col("iso_dow").isNotNull()).join(s, F.col("jenis") == F.col("_s")).drop("_s")


def dim_shift(jadwal: DataFrame, shift: DataFrame) -> DataFrame:
    """One row for each schedule: its shift, weekday and time flags."""
    s = shift.select(F.col("id").alias("_s"), F.col("nama").alias("shift_name"), F.col("status").alias("shift_active"), "departemen_id")
    j = jadwal.join(s, F.col("jenis") == F.col("_s"), "left")
    return j.select(
        "id", "jenis", "shift_name", "shift_active", "departemen_id",
        F.coalesce(F.contains(F.upper("shift_name"), F.lit("REGULER")), F.lit(False)).alias("is_regular"), R.weekday("hari").alias("iso_dow"),
        R.flexible("is_flexible").alias("is_flexible"), R.flexible_invalid("is_flexible").alias("flexible_invalid"),
        (F.col("jam_keluar") < F.col("jam_masuk")).alias("is_overnight"), (F.col("jam_keluar") == F.col("jam_masuk")).alias("is_zero_length"),
    )


def inout_daily(events: DataFrame) -> DataFrame:
    return events.where("pegawai_id is not null").groupBy("pegawai_id",
        F.to_date("created_at").alias("tanggal")).agg(F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


def event_employee_view(events: DataFrame, pegawai: DataFrame, departemen: DataFrame) -> DataFrame:
    p = pegawai.select(F.col("id").alias("pegawai_id"), F.col("nama").alias("employee"), F.col("departemen").alias("_d"), "status")
    d = departemen.select(F.col("id").alias("_d"), F.col("nama_departemen").alias("department"))
    return events.join(p, "pegawai_id").join(d, "_d").select("id", "pegawai_id", R.mask_identifier("employee").alias("masked"), "department",
        R.event_type().alias("kind"), F.to_date("created_at").alias("tanggal"))


def leave_view(leaves: DataFrame, jenis: DataFrame) -> DataFrame:
    k = jenis.select(F.col("id").alias("jenis_ijin"), F.col("nama").alias("leave_kind"))
    scope = F.when(F.col("tipe_ijin") == 1, "full day").when(F.col("tipe_ijin") == 2, "no check-in").when(F.col("tipe_ijin") == 3, "no check-out").otherwise("-")
    return leaves.join(k, "jenis_ijin").select("id", "pegawai_id", "leave_kind", scope.alias("scope"), F.when(R.true("approval"), "Approved").otherwise("-").alias("approval"))


_DAYS = "SELECT pegawai_id, tanggal_event AS tanggal, jadwal_id, count(*) FILTER (checktype = 1) AS n_in, count(*) FILTER (checktype = 2) AS n_out FROM {ev} GROUP BY ALL"
_ISO = (
    "CASE WHEN lower(trim(hari)) IN ('senin', 'monday') THEN 1 WHEN lower(trim(hari)) IN ('selasa', 'tuesday') THEN 2 "
    "WHEN lower(trim(hari)) IN ('rabu', 'wednesday') THEN 3 WHEN lower(trim(hari)) IN ('kamis', 'thursday') THEN 4 "
    "WHEN lower(trim(hari)) IN ('jumat', 'friday') THEN 5 WHEN lower(trim(hari)) IN ('sabtu', 'saturday') THEN 6 "
    "WHEN lower(trim(hari)) IN ('minggu', 'sunday') THEN 7 END"
)
_BUCKET = "CASE WHEN n < 5 THEN '0' || n WHEN n < 10 THEN '05-09' WHEN n < 20 THEN '10-19' ELSE '20+' END"
_GAPS = (
    "SELECT DATE '2023-11-01' AS month FROM {region} WHERE r_regionkey = 0 UNION ALL SELECT DISTINCT CAST(date_trunc('month', "
    "created_at) AS DATE) FROM {t_checkinout}"
)


def report_join_view(reports: DataFrame, user: DataFrame, pegawai: DataFrame, departemen: DataFrame) -> DataFrame:
    """Reports with their user's employee and department, newest first."""
    u = user.select(F.col("id").alias("user_id"), "pegawai_id")
    p = pegawai.select(F.col("id").alias("pegawai_id"), "nama", F.col("departemen").alias("departemen_id"))
    d = departemen.select(F.col("id").alias("departemen_id"), "nama_departemen")
    return reports.drop("pegawai_id").join(u, "user_id").join(p, "pegawai_id").join(d, "departemen_id").orderBy(F.desc("id"))


def photo_counts(pegawai: DataFrame, departemen: DataFrame) -> DataFrame:
    """By the first three characters of the department's code: employees, photos and approved photos.

    Inactive employees and codes under three characters don't count; the name is that of the department whose code is the prefix.
    """
    d = departemen.where(F.length("kode") >= 3).select(F.col("id").alias("departemen"), F.substring("kode", 1, 3).alias("kode"))
    rows = pegawai.where("status <> 5").join(d, "departemen").groupBy("kode").agg(F.count("*").alias("people"), F.count("foto").alias("photos"),
        F.count_if(F.col("is_foto_approved") == 1).alias("approved"))
    names = departemen.select("kode", "nama_departemen")
    return rows.join(names, "kode", "left").groupBy("kode", "nama_departemen").agg(*(F.sum(c).alias(c) for c in ("people", "photos", "approved")))


def unit_profile(pegawai: DataFrame, departemen: DataFrame) -> DataFrame:
    """By unit (the part of the full code before ' - ') and code prefix: employees by sex, category, platform and education.

    Inactive employees and departments whose code begins with HAPUS (deleted) don't count.
    """
    d = departemen.where("left(kode, 5) <> 'HAPUS'").select(F.col("id").alias("departemen"),
        F.split_part("kode_lengkap", F.lit(" - "), F.lit(1)).alias("unit"), F.substring("kode", 1, 3).alias("kode"))
    learnt = lambda level: F.contains(F.lower("attrs"), F.lit(f'"pendidikan":"{level}"'.lower()))
    counts = {"male": F.col("jenis_kelamin") == 1, "female": F.col("jenis_kelamin") == 2}
    counts |= {f"category_{k}": F.col("status") == k for k in (1, 2, 3, 4)}
    counts |= {n: F.col("other_attr") == k for n, k in (("android", "1"), ("apple", "2"), ("web", "3"))} | {"platform_unset": F.col("other_attr").isNull()}
    counts |= {n: learnt(x) for n, x in (("sd", "SD"), ("sltp", "SLTP"), ("slta", "SLTA"), ("d3", "D-III"), ("s1", "S-1"), ("d4", "D-IV"), ("s2", "S-2"), ("s3", "S-3"))}
    return pegawai.where("status <> 5").join(d, "departemen").groupBy("unit", "kode").agg(F.count("unit").alias("people"), *(F.count_if(c).alias(n) for n, c in counts.items()))


def coverage_by_department(shift: DataFrame, jadwal: DataFrame) -> DataFrame:
    """Distinct shifts, schedules and active shifts of each department. Schedules are counted by shift first."""
    j = jadwal.groupBy(F.col("jenis").alias("id")).agg(F.count_distinct("id").alias("schedules"))
    return shift.join(j, "id", "left").groupBy("departemen_id").agg(
        F.count_distinct("id").alias("shift_count"), F.coalesce(F.sum("schedules"), F.lit(0)).cast("long").alias("schedule_count"),
        F.count_distinct(F.when(F.col("status"), F.col("id"))).alias("active_shift_count")
    )


_CODE = (
    "CASE WHEN id % 9 = 8 THEN concat('HAPUS', nama_departemen) WHEN id % 2 = 0 THEN substr(nama_departemen, 1, 3) "
    "ELSE concat(substr(nama_departemen, 1, 3), '.', CAST(id AS STRING)) END"
)
_UNITS = f"SELECT id, nama_departemen, {_CODE} AS kode, concat(substr(nama_departemen, 1, 1), ' - ', nama_departemen) AS kode_lengkap FROM {{m_departemen}}"
_STAFF = [
    "id", "departemen", "status", "id % 2 + 1 AS jenis_kelamin", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS foto", "id % 4 AS is_foto_approved",
    "CASE WHEN id % 4 > 0 THEN CAST(id % 4 AS STRING) END AS other_attr",
    """CASE id % 5 WHEN 0 THEN '{"pendidikan":"SD"}' WHEN 1 THEN '{"pendidikan":"S-1"}' WHEN 2 THEN '{"PENDIDIKAN":"d-iii"}' WHEN 3 THEN '{}' END AS attrs""",
]
_STAFF_SQL = f"SELECT {', '.join(_STAFF)} FROM {{m_pegawai}}"
_LEVELS = (("sd", "SD"), ("sltp", "SLTP"), ("slta", "SLTA"), ("d3", "D-III"), ("s1", "S-1"), ("d4", "D-IV"), ("s2", "S-2"), ("s3", "S-3"))


def _units(t) -> DataFrame:
    return t.spark.sql(_UNITS, m_departemen=t.m_departemen)


def _staff(t) -> DataFrame:
    return t.m_pegawai.selectExpr(*_STAFF)


def _months(t) -> DataFrame:
    return t.region.where("r_regionkey = 0").select(F.lit("2023-11-01").cast("date").alias("month")).union(t.t_checkinout.select(F.to_date("created_at")))


QUERIES = {
    "report_join_view": (
        lambda t: report_join_view(t.t_perizinan.select("id", "user_id", "tipe_ijin"), t.m_user, t.m_pegawai, t.m_departemen),
        """SELECT a.id, a.user_id, a.tipe_ijin, u.pegawai_id, p.nama, p.departemen AS departemen_id, d.nama_departemen FROM {t_perizinan} a JOIN {m_user} u ON u.id = a.user_id
           JOIN {m_pegawai} p ON p.id = u.pegawai_id JOIN {m_departemen} d ON d.id = p.departemen ORDER BY a.id DESC""",
    ),
    "photo_counts": (
        lambda t: photo_counts(_staff(t), _units(t)),
        f"""SELECT left(b.kode, 3) AS kode, d.nama_departemen, count(*) AS people, count(a.foto) AS photos,
            count(*) FILTER (a.is_foto_approved = 1) AS approved FROM ({_STAFF_SQL}) a JOIN ({_UNITS}) b ON b.id = a.departemen
            LEFT JOIN ({_UNITS}) d ON d.kode = left(b.kode, 3) WHERE a.status <> 5 AND length(b.kode) >= 3 GROUP BY ALL""",
    ),
    "unit_profile": (
        lambda t: unit_profile(_staff(t), _units(t)),
        f"""SELECT split_part(b.kode_lengkap, ' - ', 1) AS unit, left(b.kode, 3) AS kode, count(*) AS people,
            count(*) FILTER (jenis_kelamin = 1) AS male, count(*) FILTER (jenis_kelamin = 2) AS female,
            {', '.join(f'count(*) FILTER (status = {k}) AS category_{k}' for k in (1, 2, 3, 4))},
                {', '.join(f"count(*) FILTER (other_attr = '{k}') AS {n}" for n, k in (('android', 1), ('apple', 2), ('web', 3)))},
            count(*) FILTER (other_attr IS NULL) AS platform_unset, {', '.join(f"count(*) FILTER (attrs ILIKE '%\"pendidikan\":\"{x}\"%') AS {n}" for n, x in _LEVELS)}
            FROM ({_STAFF_SQL}) a JOIN ({_UNITS}) b ON b.id = a.departemen WHERE a.status <> 5 AND left(b.kode, 5) <> 'HAPUS' GROUP BY ALL""",
    ),
    "coverage_by_department": (
        lambda t: coverage_by_department(t.m_shift, t.m_jadwal),
        (
            "SELECT s.departemen_id, count(DISTINCT s.id) AS shift_count, count(DISTINCT j.id) AS schedule_count, "
            "count(DISTINCT s.id) FILTER (s.status) AS active_shift_count FROM {m_shift} s LEFT JOIN {m_jadwal} j ON j.jenis = s.id "
            "GROUP BY ALL"
        ),
    ),
    "full_outer_diff": (
        lambda t: full_outer_diff(t.pop.where("pegawai_id % 4 <> 0"),
            t.pop.where("pegawai_id % 5 <> 0").withColumn("status_sumber", F.when(F.col("pegawai_id") % 7 == 0, 0).otherwise(F.col("status_sumber"))), KEYS),
        (
            "SELECT pegawai_id, tanggal FROM {pop} WHERE (pegawai_id % 4 <> 0) <> (pegawai_id % 5 <> 0) OR (pegawai_id % 4 <> 0 "
            "AND pegawai_id % 5 <> 0 AND pegawai_id % 7 = 0)"
        ),
    ),
    "join_schedule_left": (lambda t: t.ev.select("event_id", "jadwal_id", "shift_id", "shift_name"), "SELECT event_id, jadwal_id, shift_id, shift_name FROM {ev}"),
    "join_identity_check": (
        lambda t: t.lv.where(F.contains(F.col("alasan_review"), F.lit("IDENTITY_MISMATCH"))).select("perizinan_id"),
        "SELECT perizinan_id FROM {lv} WHERE contains(alasan_review, 'IDENTITY_MISMATCH')"),
    "self_join_prev_day": (lambda t: previous_day(schedule_days(t.ev)),
        (
            f"SELECT a.*, b.n_in AS prev_day_in FROM ({_DAYS}) a LEFT JOIN ({_DAYS}) b ON a.pegawai_id IS NOT DISTINCT "
            f"FROM b.pegawai_id AND a.tanggal = b.tanggal + 1 AND a.jadwal_id IS NOT DISTINCT FROM b.jadwal_id"
        )),
    "cross_totals": (lambda t: cross_totals(t.agg.select("tanggal", "departemen_key", "leave_days"), t.agg.agg(F.sum("leave_days").alias("total"))),
        "SELECT tanggal, departemen_key, leave_days, (SELECT CAST(sum(leave_days) AS BIGINT) FROM {agg}) AS total FROM {agg}"),
    "lateral_values_unpivot": (
        lambda t: unpivot(t.agg.agg(F.sum("leave_days").alias("a"), F.sum("checkin_days").alias("b"), F.sum("fact_rows").alias("c")),
            [("leave", ["a", "c"]), ("checkin", ["b", "c"])], ["value", "denominator"]),
        (
            "SELECT 'leave' AS metric, CAST(sum(leave_days) AS BIGINT) AS value, CAST(sum(fact_rows) AS BIGINT) AS denominator "
            "FROM {agg} UNION ALL SELECT 'checkin', CAST(sum(checkin_days) AS BIGINT), CAST(sum(fact_rows) AS BIGINT) FROM {agg}"
        ),
    ),
    "not_exists_delete": (lambda t: t.daily.join(t.fact.select(*KEYS), KEYS, "left_anti").select(*KEYS),
        "SELECT pegawai_id, tanggal FROM {daily} EXCEPT SELECT pegawai_id, tanggal FROM {fact}"),
    "exists_semi": (lambda t: t.m_pegawai.join(t.t_perizinan.select(F.col("pegawai_id").alias("id")), "id", "left_semi").select("id"),
        "SELECT id FROM {m_pegawai} WHERE id IN (SELECT pegawai_id FROM {t_perizinan})"),
    "coverage_full_outer": (lambda t: full_outer_diff(t.daily.select(*KEYS, "leave_days"), t.fact.select(*KEYS, "leave_days"), KEYS),
        "SELECT pegawai_id, tanggal FROM {daily} EXCEPT SELECT pegawai_id, tanggal FROM {fact}"),
    "missing_employee_days": (lambda t: missing_employee_days(t.m_pegawai, t.dates, t.evday),
        "SELECT p.id AS pegawai_id, d.tanggal FROM {m_pegawai} p CROSS JOIN {dates} d ANTI JOIN {evday} e ON e.pegawai_id = p.id AND e.tanggal = d.tanggal"),
    "usable_schedule": (
        lambda t: usable_schedules(t.m_jadwal, t.m_shift).select("id", "departemen_id", "iso_dow"),
        (
            f"SELECT j.id, s.departemen_id, iso_dow FROM (SELECT *, {_ISO} AS iso_dow FROM {{m_jadwal}}) j "
            f"JOIN {{m_shift}} s ON s.id = j.jenis AND s.status WHERE jam_masuk_awal <= jam_masuk AND jam_masuk < jam_keluar "
            f"AND jam_keluar <= jam_keluar_akhir AND jam_masuk <= 79200000000 AND iso_dow IS NOT NULL"
        ),
    ),
    "weekday_normalise": (lambda t: t.m_jadwal.select("id", R.weekday("hari").alias("iso_dow")), f"SELECT id, {_ISO} AS iso_dow FROM {{m_jadwal}}"),
    "merge_dim_shift": (
        lambda t: dim_shift(t.m_jadwal, t.m_shift),
        f"""SELECT j.id, jenis, s.nama AS shift_name, s.status AS shift_active, s.departemen_id, coalesce(contains(upper(s.nama), 'REGULER'),
            false) AS is_regular, {_ISO} AS iso_dow,
            CASE is_flexible WHEN 0 THEN false WHEN 1 THEN true END AS is_flexible, is_flexible NOT IN (0, 1) AS flexible_invalid,
                jam_keluar < jam_masuk AS is_overnight, jam_keluar = jam_masuk AS is_zero_length
            FROM {{m_jadwal}} j LEFT JOIN {{m_shift}} s ON s.id = j.jenis""",
    ),
    "inout_daily": (lambda t: inout_daily(t.t_checkinout),
        (
            "SELECT pegawai_id, CAST(created_at AS DATE) AS tanggal, min(created_at) AS first_at, max(created_at) AS last_at "
            "FROM {t_checkinout} WHERE pegawai_id IS NOT NULL GROUP BY ALL"
        )),
    "event_employee_view": (
        lambda t: event_employee_view(t.t_checkinout, t.m_pegawai, t.m_departemen),
        """SELECT e.id, e.pegawai_id, concat(substr(p.nama, 1, greatest(length(p.nama) - 5, 0)), '*****') AS masked, d.nama_departemen AS department,
           CASE e.checktype WHEN 1 THEN 'MASUK' WHEN 2 THEN 'PULANG' ELSE 'LAIN' END AS kind, CAST(e.created_at AS DATE) AS tanggal
               FROM {t_checkinout} e JOIN {m_pegawai} p ON p.id = e.pegawai_id JOIN {m_departemen} d ON d.id = p.departemen""",
    ),
    "leave_view": (
        lambda t: leave_view(t.t_perizinan, t.m_jenis_ijin),
        (
            "SELECT l.id, l.pegawai_id, k.nama AS leave_kind, CASE l.tipe_ijin WHEN 1 THEN 'full day' WHEN 2 THEN 'no check-in' "
            "WHEN 3 THEN 'no check-out' ELSE '-' END AS scope, CASE WHEN l.approval THEN 'Approved' ELSE '-' END AS approval "
            "FROM {t_perizinan} l JOIN {m_jenis_ijin} k ON k.id = l.jenis_ijin"
        ),
    ),
    "approval_category": (
        lambda t: t.t_checkinout.groupBy(R.approval_category().alias("category")).agg(F.count("*").alias("n")),
        """SELECT CASE WHEN is_manual IS NULL THEN 'manual_null' WHEN is_manual THEN 'manual' ELSE 'automatic' END || CASE
            WHEN approval_at IS NULL THEN '_not_approved' ELSE '_approved' END AS category, count(*) AS n
           FROM {t_checkinout} GROUP BY ALL""",
    ),
    "duplicate_signature": (lambda t: duplicate_signature(t.t_checkinout, ["pegawai_id", "jadwal_id", "checktype"]).where("copy > 1").select("id",
        F.col("copy").cast("long").alias("copy")),
            "SELECT id, copy FROM (SELECT id, row_number() OVER (PARTITION BY pegawai_id, jadwal_id, checktype ORDER BY id) AS copy FROM {t_checkinout}) WHERE copy > 1"),
    "previous_event": (
        lambda t: previous_event(t.t_checkinout, ["pegawai_id"], gap="INTERVAL 2 HOURS").select("id", "prev_at", "near", "near_later"),
        """SELECT id, prev_at, coalesce(created_at - prev_at < INTERVAL 2 HOUR, false) AS near, coalesce(created_at - prev_at < INTERVAL 2 HOUR
            AND created_at > prev_at, false) AS near_later
           FROM (SELECT id, created_at, lag(created_at) OVER (PARTITION BY pegawai_id ORDER BY created_at, id) AS prev_at FROM {t_checkinout})""",
    ),
    "dense_cohort_number": (lambda t: dense_number(t.m_pegawai.select("id", "departemen"), F.col("departemen"), F.col("id")),
        "SELECT id, departemen, row_number() OVER (ORDER BY departemen, id) AS n FROM {m_pegawai}"),
    "rank_within_department": (lambda t: number_within(t.m_pegawai.select("id", "departemen"), ["departemen"], F.col("id")).where("nth <= 3"),
        (
            "SELECT id, departemen, CAST(nth AS INT) AS nth FROM (SELECT id, departemen, row_number() OVER (PARTITION BY departemen "
            "ORDER BY id) AS nth FROM {m_pegawai}) WHERE nth <= 3"
        )),
    "distinct_on": (lambda t: first_by(t.t_checkinout.where("pegawai_id is not null"), ["pegawai_id"], F.col("created_at").desc(),
        F.col("id").desc()).select("pegawai_id", "id"),
            "SELECT DISTINCT ON (pegawai_id) pegawai_id, id FROM {t_checkinout} WHERE pegawai_id IS NOT NULL ORDER BY pegawai_id, created_at DESC, id DESC"),
    "array_pick": (lambda t: nth_by(t.m_jadwal, ["jenis"], 2, F.col("jam_masuk"), F.col("id")).select("jenis", "id"),
        "SELECT jenis, id FROM (SELECT jenis, id, row_number() OVER (PARTITION BY jenis ORDER BY jam_masuk, id) AS n FROM {m_jadwal}) WHERE n = 2"),
    "union_distinct_keys": (lambda t: t.evday.select(*KEYS).union(t.lvsum.select(*KEYS)).distinct(),
        "SELECT pegawai_id, tanggal FROM {evday} UNION SELECT pegawai_id, tanggal FROM {lvsum}"),
    "except_rows": (lambda t: t.daily.select(*KEYS).subtract(t.fact.select(*KEYS)), "SELECT pegawai_id, tanggal FROM {daily} EXCEPT SELECT pegawai_id, tanggal FROM {fact}"),
    "except_all_both_ways": (lambda t: except_both_ways(t.m_pegawai.select("departemen"), t.m_departemen.select(F.col("id").alias("departemen"))),
        (
            "SELECT departemen, 'left' AS side FROM (SELECT departemen FROM {m_pegawai} EXCEPT ALL SELECT id FROM {m_departemen}) "
            "UNION ALL SELECT id, 'right' FROM (SELECT id FROM {m_departemen} EXCEPT ALL SELECT departemen FROM {m_pegawai})"
        )),
    "month_gap_fill": (lambda t: month_gaps(_months(t)),
        (
            f"SELECT CAST(m AS DATE) AS month FROM (SELECT unnest(generate_series(CAST((SELECT min(month) "
            f"FROM ({_GAPS})) AS TIMESTAMP), CAST((SELECT max(month) FROM ({_GAPS})) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m) "
            f"WHERE CAST(m AS DATE) NOT IN (SELECT month FROM ({_GAPS}))"
        )),
    "cross_generate": (lambda t: cross_generate(t.m_pegawai.select("id"), [1, 2]), "SELECT id, unnest([1, 2]) AS side FROM {m_pegawai}"),
    "stable_bucket": (
        lambda t: t.m_pegawai.select("id", R.stable_bucket_number("id", seed="s").alias("bucket"),
            R.stable_bucket(R.stable_bucket_number("id", seed="s"), [("a", 58), ("b", 30), ("c", 12)]).alias("label")),
        (
            "SELECT id, bucket, CASE WHEN bucket < 58 THEN 'a' WHEN bucket < 88 THEN 'b' ELSE 'c' END AS label FROM (SELECT id, "
            "CAST(('0x' || substr(md5(id || '/s'), 1, 8)) AS BIGINT) % 100 AS bucket FROM {m_pegawai})"
        ),
    ),
    "histogram_buckets": (
        lambda t: t.t_checkinout.groupBy("pegawai_id",
            F.to_date("created_at").alias("d")).agg(F.count("*").alias("n")).groupBy(R.bucket_of_count("n").alias("bucket")).agg(F.count("*").alias("days")),
        (
            f"SELECT {_BUCKET} AS bucket, count(*) AS days FROM (SELECT pegawai_id, CAST(created_at AS DATE) AS d, count(*) AS n "
            f"FROM {{t_checkinout}} GROUP BY ALL) GROUP BY ALL"
        ),
    ),
    "distinct_tuple_count": (lambda t: t.ev.agg(F.count_distinct(F.struct("pegawai_id", "tanggal_event")).alias("n")),
        "SELECT count(*) AS n FROM (SELECT DISTINCT pegawai_id, tanggal_event FROM {ev})"),
    "conditional_counts": (lambda t: t.ev.agg(F.count_if(F.col("checktype") == 1).alias("a"), F.count_if(R.true("is_manual")).alias("b")),
        "SELECT count(*) FILTER (checktype = 1) AS a, count(*) FILTER (is_manual) AS b FROM {ev}"),
    "median_minutes": (lambda t: exact_percentile(t.ev, F.col("jam") / 60_000_000, 0.5, 1.0, "m").select(F.round("m", 2).alias("minutes")),
        "SELECT round(quantile_cont(jam / 60000000.0, 0.5), 2) AS minutes FROM {ev}"),
    "distribution": (lambda t: t.m_pegawai.groupBy("status").count().withColumnRenamed("count", "n"), "SELECT status, count(*) AS n FROM {m_pegawai} GROUP BY status"),
    "first_user": (lambda t: t.m_user.groupBy("pegawai_id").agg(F.min("id").alias("user_id")), "SELECT pegawai_id, min(id) AS user_id FROM {m_user} GROUP BY ALL"),
    "daily_totals": (lambda t: t.daily.groupBy("tanggal").agg(F.count("*").alias("n"), F.sum("checkin_days").alias("checkin_days")),
        "SELECT tanggal, count(*) AS n, CAST(sum(checkin_days) AS BIGINT) AS checkin_days FROM {daily} GROUP BY ALL"),
    "time_range": (lambda t: t.t_checkinout.agg(F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")),
        "SELECT min(created_at) AS first_at, max(created_at) AS last_at FROM {t_checkinout}"),
}
