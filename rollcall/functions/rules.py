"""Column expressions: classifications, measures, labels and small helpers.

All are built-in Spark expressions, so they stay inside generated code. Three-valued logic is
explicit: ``true(c)`` is "c IS TRUE", ``a.eqNullSafe(b)`` is "IS NOT DISTINCT FROM". Times of day are
microseconds since midnight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Employment statuses that count as active or not; others are unknown.
ACTIVE_STATUS = {1: True, 2: True, 3: True, 4: True, 5: False}
POLICY = "SAME_DAY_PROVISIONAL_V1"
MEASURES = (
    "active_employee_days", "checkin_days", "checkout_days", "no_checkin_days", "no_checkout_days", "leave_days",
    "required_checkin_days", "required_checkout_days", "excused_checkin_days", "excused_checkout_days",
    "required_checkin_present_days", "required_checkout_present_days",
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def true(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit(False))


def false(c: Column | str) -> Column:
    return F.coalesce(~_c(c), F.lit(False))


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The labels whose condition holds, joined by ``;``; null if none does."""
    joined = F.concat_ws(";", *(F.when(c, label) for c, label in pairs))
    return F.nullif(joined, F.lit(""))


def join_texts(*texts: Column | str) -> Column:
    return F.nullif(F.concat_ws(";", *map(_c, texts)), F.lit(""))


def distinct_texts(c: Column | str) -> Column:
    """Distinct non-null texts of a group in sorted order, joined by ``;``; null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(_c(c))), ";"), F.lit(""))


def checkin_window(t: Column | str, early: Column | str, start: Column | str) -> Column:
    t, early, start = _c(t), _c(early), _c(start)
    unknown = t.isNull() | early.isNull() | start.isNull() | (early > start)
    return F.when(unknown, "UNKNOWN").when(t > start, "LATE").otherwise("ON_TIME")


def checkout_window(t: Column | str, end: Column | str, last: Column | str) -> Column:
    t, end, last = _c(t), _c(end), _c(last)
    unknown = t.isNull() | end.isNull() | last.isNull() | (end > last)
    return F.when(unknown, "UNKNOWN").when(t < end, "BEFORE_WINDOW").when(t > last, "AFTER_WINDOW").otherwise("IN_WINDOW")


def event_type(checktype: Column | str = "checktype") -> Column:
    c = _c(checktype)
    return F.when(c == 1, "MASUK").when(c == 2, "PULANG").otherwise("LAIN")


def event_type_valid(checktype: Column | str = "checktype") -> Column:
    return true(_c(checktype).isin(1, 2))


def measures() -> dict[str, Column]:
    """The twelve additive measures of one employee and date."""
    a, ci, co = true("is_employee_active"), F.col("checkin_event_count") > 0, F.col("checkout_event_count") > 0
    ei, eo, leave = true("has_excused_checkin"), true("has_excused_checkout"), true("has_valid_leave")
    rules = (a, a & ci, a & co, a & ~ei & ~ci, a & ~eo & ~co, a & leave, a & ~ei, a & ~eo, a & ei, a & eo, a & ~ei & ci, a & ~eo & co)
    return {name: rule.cast("int") for name, rule in zip(MEASURES, rules, strict=True)}


def rate(part: Column | str, whole: Column | str, digits: int | None = None) -> Column:
    """100 * part / whole; null where whole is 0."""
    r = F.lit(100.0) * _c(part) / F.nullif(_c(whole), F.lit(0))
    return F.round(r, digits) if digits is not None else r


def rates(digits: int | None = None) -> dict[str, Column]:
    return {
        "checkin_rate": rate("checkin_days", "active_employee_days", digits),
        "checkout_rate": rate("checkout_days", "active_employee_days", digits),
        "required_checkin_rate": rate("required_checkin_present_days", "required_checkin_days", digits),
        "required_checkout_rate": rate("required_checkout_present_days", "required_checkout_days", digits),
    }


def approval_category(manual: Column | str = "is_manual", approved: Column | str = "approval_at") -> Column:
    m, a = _c(manual), _c(approved).isNotNull()
    return (
        F.when(m.isNull() & a, "manual_null_approved").when(m.isNull(), "manual_null_not_approved")
        .when(m & a, "manual_approved").when(m, "manual_not_approved")
        .when(a, "automatic_approved").otherwise("automatic_not_approved")
    )


def mask_identifier(c: Column | str, hidden: int = 5) -> Column:
    """The text with its last characters replaced; shorter texts are hidden whole."""
    c = _c(c)
    return F.concat(F.substr(c, F.lit(1), F.greatest(F.length(c) - hidden, F.lit(0))), F.lit("*" * hidden))


_WEEKDAYS = (("senin", "monday", 1), ("selasa", "tuesday", 2), ("rabu", "wednesday", 3), ("kamis", "thursday", 4), ("jumat", "friday", 5),
    ("sabtu", "saturday", 6), ("minggu", "sunday", 7))


def weekday(c: Column | str) -> Column:
    """ISO number of an English or Indonesian weekday name; null if unknown."""
    name, out = F.lower(F.trim(_c(c))), F.lit(None).cast("int")
    for local, english, n in reversed(_WEEKDAYS):
        out = F.when(name.isin(local, english), n).otherwise(out)
    return out


def flexible(c: Column | str) -> Column:
    return F.when(_c(c) == 0, False).when(_c(c) == 1, True)


def flexible_invalid(c: Column | str) -> Column:
    return _c(c).isNotNull() & ~_c(c).isin(0, 1)


def label(name: Column | str, number: Column | str, prefix: str = "Department ") -> Column:
    return F.coalesce(_c(name), F.concat(F.lit(prefix), _c(number).cast("string")), F.lit("UNKNOWN"))


def publication_status(provisional: Column | str) -> Column:
    return F.when(_c(provisional), "PROVISIONAL").otherwise("FINAL")


def suppress_small(n: Column | str, below: int = 5) -> Column:
    """A count as text, ``<5`` for small ones."""
    n = F.coalesce(_c(n), F.lit(0))
    return F.when(n.between(1, below - 1), f"<{below}").otherwise(n.cast("string"))


def suppress_percent(percent: Column | str, n: Column | str, below: int = 5) -> Column:
    return F.when(~F.coalesce(_c(n), F.lit(0)).between(1, below - 1), _c(percent))


def calendar_key(d: Column | str) -> Column:
    d = _c(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def stable_bucket_number(*key: Column | str, seed: str = "") -> Column:
    """0..99 from the md5 of the key texts: the same everywhere, whatever the order of rows."""
    text = F.concat_ws("/", *(_c(k).cast("string") for k in key), F.lit(seed))
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("long") % 100


def stable_bucket(number: Column, shares: list[tuple[str, int]]) -> Column:
    """The label into whose share of 100 a bucket number falls."""
    out, upto = None, 0
    for name, share in shares:
        upto += share
        out = F.when(number < upto, name) if out is None else out.when(number < upto, name)
    return out


def period_start(preset: str, end: dt.date) -> dt.date:
    """First day of an inclusive period: nD ends n days back less one; nM and nY start a day after the same
    day n months earlier, clamped to that month's length."""
    n, unit = int(preset[:-1]), preset[-1].upper()
    if (n, unit) not in {(3, "D"), (7, "D"), (1, "M"), (3, "M"), (6, "M"), (1, "Y")}:
        raise ValueError(f"unknown period: {preset}")
    if unit == "D":
        return end - dt.timedelta(days=n - 1)
    months = end.year * 12 + end.month - 1 - n * (12 if unit == "Y" else 1)
    first = dt.date(months // 12, months % 12 + 1, 1)
    last = (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
    return first.replace(day=min(end.day, last.day)) + dt.timedelta(days=1)


def period_start_column(preset: str, end: Column | str) -> Column:
    n, unit = int(preset[:-1]), preset[-1].upper()
    if unit == "D":
        return F.date_sub(_c(end), n - 1)
    return F.date_add(F.add_months(_c(end), -n * (12 if unit == "Y" else 1)), 1)


def bucket_of_count(n: Column | str) -> Column:
    n = _c(n)
    return (
        F.when(n < 5, F.lpad(n.cast("string"), 2, "0")).when(n < 10, "05-09").when(n < 20, "10-19").otherwise("20+")
    )


def bound_order(early: Column | str, start: Column | str) -> Column:
    return F.when(_c(early).isNull() | _c(start).isNull(), "missing").when(_c(early) > _c(start), "reversed").otherwise("ordered")


def legacy_pair_status(n_in: Column, n_out: Column, first_in: Column, last_out: Column, schedules: Column, leave: Column) -> Column:
    """Superseded pairing: approved leave wins; one in and one out in order on one schedule is a pair; else review."""
    pair = (n_in == 1) & (n_out == 1) & (last_out >= first_in) & (schedules <= 1)
    return F.when(true(leave), "LEAVE").when(true(pair), "PAIRED").otherwise("REVIEW")
