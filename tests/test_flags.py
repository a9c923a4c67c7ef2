"""Conditions of events and places in windows, on rows made for each of them."""

import datetime as dt

import pytest

from rollcall.operators import event_flags as E
from rollcall.operators.incremental import manifest_build

AT = dt.datetime(2024, 1, 8, 7, 30)
H = 3_600_000_000
EVENT = "id int, pegawai_id int, jadwal_id int, checktype int, is_wfh int, is_manual boolean, created_at timestamp, approval_at timestamp, updated_at timestamp"
CLEAN = {"id": 1, "pegawai_id": 1, "jadwal_id": 5, "checktype": 1, "is_wfh": 0, "is_manual": False, "created_at": AT, "approval_at": None, "updated_at": AT}


@pytest.fixture(scope="module")
def masters(spark):
    jadwal = spark.createDataFrame([(5,)], "id int")
    return jadwal, spark.createDataFrame([(1, 3, AT - dt.timedelta(days=9)), (2, 4, AT + dt.timedelta(days=1))], "id int, departemen int, created_at timestamp")


CASES = [
    ({}, {"update_compared"}),
    ({"jadwal_id": None}, {"schedule_unset", "update_compared"}),
    ({"jadwal_id": 6}, {"schedule_dangling", "update_compared"}),
    ({"checktype": None}, {"kind_outside", "update_compared"}),
    ({"checktype": 3, "is_wfh": 2}, {"kind_outside", "wfh_outside", "update_compared"}),
    ({"is_wfh": None, "is_manual": None}, {"wfh_outside", "manual_outside", "update_compared"}),
    ({"is_manual": True}, {"manual_unapproved", "update_compared"}),
    ({"is_manual": True, "approval_at": AT}, {"update_compared"}),
    ({"is_manual": True, "approval_at": AT - dt.timedelta(seconds=1)}, {"approval_before_event", "update_compared"}),
    ({"approval_at": AT}, {"automatic_approved", "update_compared"}),
    ({"is_manual": None, "approval_at": AT}, {"manual_outside", "update_compared"}),
    ({"pegawai_id": 2}, {"event_before_entry", "update_compared"}),
    ({"pegawai_id": None}, {"update_compared"}),
    ({"created_at": None}, {"event_unset"}),
    ({"created_at": AT + dt.timedelta(days=2), "updated_at": None}, {"event_on_snapshot", "update_unset"}),
    ({"created_at": AT + dt.timedelta(days=3)}, {"event_after_snapshot", "update_compared", "update_differs", "update_before_event"}),
    ({"updated_at": AT + dt.timedelta(seconds=1)}, {"update_compared", "update_differs"}),
]


def test_flags(spark, masters):
    rows = [tuple((CLEAN | change | {"id": i}).values()) for i, (change, _) in enumerate(CASES)]
    got = {r.id: r for r in E.event_quality(spark.createDataFrame(rows, EVENT), *masters, dt.date(2024, 1, 10)).collect()}
    for i, (change, want) in enumerate(CASES):
        assert {n for n in E.NAMES if got[i][n]} == want, change
        assert all(got[i][n] is not None for n in E.NAMES)
    assert len(E.DEFECTS) == 10 and len(set(E.NAMES)) == len(E.NAMES)


def test_places_in_windows(spark):
    """At, between and beyond the bounds; equal and falling bounds and unknown times are in no place."""
    of = "checktype int, jadwal_id int, pegawai_id int, created_at timestamp, work_code int, is_manual boolean, jam bigint, jam_masuk_awal bigint, jam_masuk bigint, jam_keluar bigint, jam_keluar_akhir bigint"
    jadwal = spark.createDataFrame([(5, 2, "Senin", 6 * H, 7 * H, 15 * H, 18 * H)], "id int, jenis int, hari string, jam_masuk_awal bigint, jam_masuk bigint, jam_keluar bigint, jam_keluar_akhir bigint")
    shift, staff = spark.createDataFrame([(2, 3)], "id int, departemen_id int"), spark.createDataFrame([(1, 3), (2, 4)], "id int, departemen int")
    event = lambda kind, jam, a=6, b=7, c=15, d=18, who=1: (kind, 5, who, AT, 2, True, None if jam is None else int(jam * H), *(None if x is None else x * H for x in (a, b, c, d)))
    ins = [event(1, x) for x in (5, 6, 6.5, 7, 8, None)] + [event(1, 6, 7, 7), event(1, 6, 8, 7), event(1, 6, None, 7, who=2)]
    outs = [event(2, x) for x in (14, 15, 16, 18, 19)] + [event(2, 16, 6, 16), event(2, 16, 6, 15), event(2, 16, 6, 7, 15, 15), event(2, 16, 6, 7, 15, 14)]
    rows = spark.createDataFrame(ins + outs, of)
    one = {side: E.window_profile(rows, jadwal, shift, staff, side).where("year = 'ALL'").first().asDict() for side in ("in", "out")}
    i, o = one["in"], one["out"]
    assert [i[f"place_{n}"] for n in ("below", "at_jam_masuk_awal", "between", "at_jam_masuk", "beyond")] == [1, 1, 1, 1, 1]
    assert (i["window_rising"], i["window_equal"], i["window_falling"], i["no_jam_masuk_awal"], i["other_jam_masuk_awal"], i["other_owner"], i["events"], i["manual"]) == (6, 1, 1, 1, 2, 1, 9, 9)
    assert [o[f"place_{n}"] for n in ("below", "at_jam_keluar", "between", "at_jam_keluar_akhir", "beyond")] == [1, 1, 1, 1, 1]
    assert (o["day_rising"], o["day_equal"], o["day_falling"], o["window_rising"], o["window_equal"], o["window_falling"]) == (7, 1, 1, 5, 1, 1)
    assert i["other_weekday"] == 0 and i["other_code"] == 0 and i["no_shift"] == 0


def test_manifests_by_entity(spark):
    rows = [(1, "LEAVE", [1, 2, 2, None], [2]), (1, "EVENT", [2], None), (2, "LEAVE", None, [7, 7]), (3, "LEAVE", [], [])]
    batches = spark.createDataFrame(rows, "batch_id int, entity string, upserts array<int>, deletes array<int>")
    got = sorted((r.batch_id, r.entity, r.source_id, r.operation) for r in manifest_build(batches).collect())
    assert got == [(1, "EVENT", 2, "UPSERT"), (1, "LEAVE", 1, "UPSERT"), (1, "LEAVE", 2, "DELETE"), (2, "LEAVE", 7, "DELETE")]
