"""Conditions of events, made from a few families; each family knows the test that its defects belong to.

A family turns columns into named Boolean columns that are never null: a reference is absent or dangles, a value
lies outside its domain, one time comes before another, two settings contradict each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import rules as R


@dataclass(frozen=True)
class Flag:
    """A condition (made from the snapshot's date), the test that reports it, and whether it counts as damage."""

    name: str
    test: str
    condition: Callable[[dt.date], Column]
    defect: bool = True


def reference(name: str, test: str, pointer: str, found: str) -> list[Flag]:
    """A pointer to a master is unset, or points to no row."""
    unset = Flag(f"{name}_unset", test, lambda _: F.col(pointer).isNull())
    return [unset, Flag(f"{name}_dangling", test, lambda _: F.col(pointer).isNotNull() & F.col(found).isNull())]


def outside(name: str, test: str, value: str, *domain) -> Flag:
    """Null counts as outside of any domain."""
    return Flag(f"{name}_outside", test, lambda _: ~R.true(F.col(value).isin(*domain)))


#: Times of an event: its own, its approval's, its last update's, and its employee's entry.
TIMES = {"event": "created_at", "approval": "approval_at", "update": "updated_at", "entry": "p_at"}


def before(early: str, late: str, test: str, defect: bool = True) -> Flag:
    return Flag(f"{early}_before_{late}", test, lambda _: R.true(F.col(TIMES[early]) < F.col(TIMES[late])), defect)


def approval(name: str, manual: bool, approved: bool) -> Flag:
    """Events made by hand need an approval, the others must have none."""
    return Flag(name, "A3", lambda _: R.true(F.col("is_manual") == manual) & (F.col(TIMES["approval"]).isNotNull() == approved))


def placed(name: str, test: str, compare: Callable[[Column, dt.date], Column]) -> Flag:
    """How an event's date stands to the snapshot's."""
    return Flag(f"event_{name}", test, lambda day: compare(F.to_date(TIMES["event"]), day), False)


def _update(compare: Callable[[Column, Column], Column]) -> Callable[[dt.date], Column]:
    return lambda _: compare(F.col(TIMES["update"]), F.col(TIMES["event"]))


FLAGS = [
    *reference("schedule", "A1", "jadwal_id", "j_id"),
    outside("kind", "A2", "checktype", 1, 2), outside("wfh", "A2", "is_wfh", 0, 1), outside("manual", "A2", "is_manual", True, False),
    approval("manual_unapproved", True, False), approval("automatic_approved", False, True), before("approval", "event", "A3"),
    before("event", "entry", "A4"),
    placed("unset", "A4", lambda d, _: d.isNull()), placed("after_snapshot", "A4", lambda d, s: R.true(d > s)), placed("on_snapshot", "A4", lambda d, s: R.true(d == s)),
    Flag("update_differs", "A7", _update(lambda u, e: R.true(u != e))), Flag("update_unset", "A7", _update(lambda u, _: u.isNull()), False),
    Flag("update_compared", "A7", _update(lambda u, e: (u - e).isNotNull()), False), before("update", "event", "A7", False),
]
NAMES = [f.name for f in FLAGS]
DEFECTS = [f for f in FLAGS if f.defect]


def event_quality(events: DataFrame, jadwal: DataFrame, pegawai: DataFrame, snapshot: dt.date) -> DataFrame:
    """Events with their employee's department and a Boolean column, never null, for each flag."""
    j = jadwal.select(F.col("id").alias("j_id"))
    p = pegawai.select(F.col("id").alias("p_id"), F.col("departemen").alias("p_departemen"), F.col("created_at").alias("p_at"))
    e = events.join(j, events["jadwal_id"] == j["j_id"], "left").join(p, events["pegawai_id"] == p["p_id"], "left")
    return e.select("*", *(f.condition(snapshot).alias(f.name) for f in FLAGS)).drop("j_id", "p_id", "p_at")


#: A side's bounds of the window, in order, and the bounds of the working day.
BOUNDS = {"in": ("jam_masuk_awal", "jam_masuk"), "out": ("jam_keluar", "jam_keluar_akhir")}
DAY = ("jam_masuk", "jam_keluar")


def compared(name: str, a: Column, b: Column) -> dict[str, Column]:
    """How ``a`` stands to ``b``; unknown in none of the three."""
    return {f"{name}_rising": a < b, f"{name}_equal": a == b, f"{name}_falling": a > b}


def window_counters(side: str) -> dict[str, Column]:
    """What a side's events are counted by: references, agreement with the master, order of bounds, place in the window."""
    low, high = BOUNDS[side]
    c = F.col
    known = c("j_id").isNotNull()
    differs = lambda a, b: known & ~a.eqNullSafe(b)
    out = {"manual": R.true("is_manual")}
    out |= {f"no_{n}": c(x).isNull() for n, x in (("schedule_id", "jadwal_id"), ("schedule", "j_id"), ("shift", "s_id"), *((x, x) for x in dict.fromkeys((*BOUNDS[side], DAY[0]))))}
    out |= {f"other_{n}": differs(c(a), c(b)) for n, a, b in (("code", "work_code", "jenis"), ("weekday", "event_dow", "schedule_dow"))}
    out |= {f"other_{x}": known & (c(x) != c(f"j_{x}")) for x in BOUNDS[side]}
    whole = F.lit(True)
    if side == "out":  # a window of check-outs counts within a day only
        out |= compared("day", *map(c, DAY))
        whole = c(DAY[0]) < c(DAY[1])
    out |= {n: x & whole for n, x in compared("window", c(low), c(high)).items()}
    # Cut points of the window: below the first, at each one, between them, beyond the last.
    open_, t = out["window_rising"], c("jam")
    out |= {"place_below": open_ & (t < c(low)), "place_between": open_ & (t > c(low)) & (t < c(high)), "place_beyond": open_ & (t > c(high))}
    out |= {f"place_at_{x}": open_ & (t == c(x)) for x in (low, high)}
    if side == "in":
        out |= {"no_owner": c("s_owner").isNull(), "other_owner": c("s_owner").isNotNull() & ~c("p_departemen").eqNullSafe(c("s_owner"))}
    return out


def window_profile(events: DataFrame, jadwal: DataFrame, shift: DataFrame, pegawai: DataFrame, side: str) -> DataFrame:
    """By year, and over all (year ``ALL``): counts of a side's events by :func:`window_counters`."""
    times = dict.fromkeys((*BOUNDS["in"], *BOUNDS["out"]))
    j = jadwal.select(F.col("id").alias("j_id"), "jenis", R.weekday("hari").alias("schedule_dow"), *(F.col(x).alias(f"j_{x}") for x in times))
    s = shift.select(F.col("id").alias("s_id"), F.col("departemen_id").alias("s_owner"))
    p = pegawai.select(F.col("id").alias("pegawai_id"), F.col("departemen").alias("p_departemen"))
    e = events.where(F.col("checktype") == (1 if side == "in" else 2)).join(j, F.col("jadwal_id") == F.col("j_id"), "left")
    e = e.join(s, F.col("jenis") == F.col("s_id"), "left").join(p, "pegawai_id", "left").withColumn("event_dow", (F.weekday("created_at") + 1).cast("int"))
    # Counts by year first; the total is summed from the years.
    counters, day = window_counters(side), F.to_date("created_at")
    years = e.groupBy(F.year("created_at").cast("string").alias("year")).agg(
        F.count("*").alias("events"), F.min(day).alias("first_date"), F.max(day).alias("last_date"), *(F.count_if(x).alias(n) for n, x in counters.items())
    )
    total = [F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), *(F.sum(n).alias(n) for n in ("events", *counters))]
    return years.groupingSets([[F.col("year")], []], F.col("year")).agg(*total).withColumn("year", F.coalesce("year", F.lit("ALL")))


# SQL of the same results, by other means: an event's state of each kind is one code, which is counted by value.
def quality_sql(events: str, snapshot: str) -> str:
    """Events with the flags, from codes: what the schedule, the approval and the times look like."""
    return f"""(SELECT * EXCLUDE (ref, apv, upd, age),
        ref = 'none' AS schedule_unset, ref = 'lost' AS schedule_dangling,
        coalesce(checktype, 0) NOT BETWEEN 1 AND 2 AS kind_outside, coalesce(is_wfh, -1) NOT BETWEEN 0 AND 1 AS wfh_outside, apv[1] = '?' AS manual_outside,
        apv = 'm-' AS manual_unapproved, apv = 'a+' AS automatic_approved, coalesce(epoch_us(approval_at) - epoch_us(created_at), 0) < 0 AS approval_before_event,
        coalesce(epoch_us(created_at) - epoch_us(entry), 0) < 0 AS event_before_entry,
        age IS NULL AS event_unset, coalesce(age, 1) < 0 AS event_after_snapshot, coalesce(age, 1) = 0 AS event_on_snapshot,
        coalesce(upd, 0) <> 0 AS update_differs, updated_at IS NULL AS update_unset, upd IS NOT NULL AS update_compared, coalesce(upd, 0) < 0 AS update_before_event
        FROM (SELECT e.*, p.departemen AS p_departemen, p.created_at AS entry,
                CASE WHEN e.jadwal_id IS NULL THEN 'none' WHEN EXISTS (SELECT 1 FROM {{m_jadwal}} j WHERE j.id = e.jadwal_id) THEN 'here' ELSE 'lost' END AS ref,
                CASE e.is_manual WHEN true THEN 'm' WHEN false THEN 'a' ELSE '?' END || CASE WHEN e.approval_at IS NULL THEN '-' ELSE '+' END AS apv,
                sign(epoch_us(e.updated_at) - epoch_us(e.created_at)) AS upd, date_diff('day', CAST(e.created_at AS DATE), DATE '{snapshot}') AS age
              FROM ({events}) e LEFT JOIN {{m_pegawai}} p ON p.id = e.pegawai_id))"""


def window_sql(side: str) -> str:
    """Counts of codes: the sign of each pair of bounds, and where among the sorted cut points the event lies."""
    low, high = BOUNDS[side]
    first = "''" if side == "in" else "CASE sign(jam_keluar - jam_masuk) WHEN 1 THEN 'r' WHEN 0 THEN 'e' WHEN -1 THEN 'f' END"
    span = f"CASE sign({high} - {low}) WHEN 1 THEN 'r' WHEN 0 THEN 'e' WHEN -1 THEN 'f' END"
    count = lambda cond, name: f"count(*) FILTER ({cond}) AS {name}"
    nulls = {"schedule_id": "jadwal_id", "schedule": "j_id", "shift": "s_id"} | {x: x for x in dict.fromkeys((low, high, "jam_masuk"))}
    parts = [count("is_manual", "manual"), *(f"count(*) - count({x}) AS no_{n}" for n, x in nulls.items())]
    parts += [count("j_id IS NOT NULL AND NOT (work_code IS NOT DISTINCT FROM jenis)", "other_code"),
        count("j_id IS NOT NULL AND NOT (event_dow IS NOT DISTINCT FROM schedule_dow)", "other_weekday")]
    parts += [count(f"abs({x} - j_{x}) > 0", f"other_{x}") for x in (low, high)]
    if side == "out":
        parts += [count(f"d = '{k}'", f"day_{n}") for k, n in zip("ref", ("rising", "equal", "falling"), strict=True)]
    parts += [count(f"w = '{k}'", f"window_{n}") for k, n in zip("ref", ("rising", "equal", "falling"), strict=True)]
    parts += [count(f"place = {k}", f"place_{n}") for k, n in ((0, "below"), (1, f"at_{low}"), (2, "between"), (3, f"at_{high}"), (4, "beyond"))]
    if side == "in":
        parts += ["count(*) - count(s_owner) AS no_owner", count("s_owner IS NOT NULL AND coalesce(p_departemen, -1) <> s_owner", "other_owner")]
    iso = "CASE lower(trim(hari)) " + " ".join(f"WHEN '{x}' THEN {n}" for *spelled, n in R._WEEKDAYS for x in spelled) + " END"  # noqa: SLF001
    return f"""SELECT coalesce(CAST(year(created_at) AS VARCHAR), 'ALL') AS year, count(*) AS events, min(CAST(created_at AS DATE)) AS first_date,
        max(CAST(created_at AS DATE)) AS last_date, {", ".join(parts)} FROM
        (SELECT *, CASE WHEN w = 'r' THEN CAST(jam >= {low} AS INT) + CAST(jam > {low} AS INT) + CAST(jam >= {high} AS INT) + CAST(jam > {high} AS INT) END AS place FROM
        (SELECT *, {first} AS d, CASE WHEN {first} IN ('', 'r') THEN {span} END AS w FROM
        (SELECT e.*, isodow(e.created_at) AS event_dow, j.id AS j_id, j.jenis, j.{low} AS j_{low}, j.{high} AS j_{high}, {iso} AS schedule_dow,
            s.id AS s_id, s.departemen_id AS s_owner, p.departemen AS p_departemen
         FROM {{t_checkinout}} e LEFT JOIN {{m_jadwal}} j ON j.id = e.jadwal_id LEFT JOIN {{m_shift}} s ON s.id = j.jenis LEFT JOIN {{m_pegawai}} p ON p.id = e.pegawai_id
         WHERE checktype = {1 if side == "in" else 2}))) GROUP BY GROUPING SETS ((year(created_at)), ())"""
