"""Units and their ancestors: kinds of parent references, chains to the root, cycles.

Chains are followed by pointer doubling: each round, a unit's ancestor becomes its ancestor's ancestor, so
a chain of a million steps takes 20 rounds. A chain that isn't at its end after more steps than there are units runs in
a circle; the ancestors reached by then are just the members of circles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.sources.scratch import written


def reference_kind(unit: Column, parent: Column, found: Column) -> Column:
    return F.when(parent.isNull(), "null").when(parent == 0, "zero").when(parent == unit, "self").when(found.isNull(), "orphan").otherwise("match")


def _referenced(units: DataFrame) -> DataFrame:
    """``id, kind, up``: the kind of the parent reference, and the parent where it is another unit."""
    p = units.select(F.col("id").alias("p_id")).distinct()
    kind = reference_kind(F.col("id"), F.col("parent"), F.col("p_id"))
    return units.join(p, units["parent"] == p["p_id"], "left").select("id", kind.alias("kind"), F.when(kind == "match", F.col("parent")).alias("up"))


def hierarchy_audit(units: DataFrame) -> DataFrame:
    return _referenced(units).groupBy(F.col("kind").alias("reference")).agg(F.count("*").alias("n"))


def hierarchy_chains(units: DataFrame) -> DataFrame:
    """``id, state, root, depth`` of each unit (``id, parent``; ids are unique).

    ``ROOTED``: ``root`` is the end of the chain and ``depth`` the number of steps to it. ``CYCLE`` and ``INTO_CYCLE``: the unit is on a circle, or
    its chain leads to one; ``root`` is the smallest unit of the circle and ``depth`` null. A parent that is null, zero, the
    unit itself or unknown ends a chain.
    """
    up = F.col("up")
    rows = _referenced(units).select("id", F.coalesce(up, F.col("id")).alias("at"), F.when(up.isNull(), 0).otherwise(1).cast("long").alias("depth"),
        up.isNull().alias("ended"), F.col("id").alias("low"))
    rows = written(rows, "chains")
    left, steps = rows.count(), 1
    while True:
        open_ = rows.where("not ended")
        jump = rows.select(F.col("id").alias("at"), F.col("at").alias("_at"), F.col("depth").alias("_depth"), F.col("ended").alias("_ended"), F.col("low").alias("_low"))
        moved = open_.join(jump, "at").select("id", F.col("_at").alias("at"), (F.col("depth") + F.col("_depth")).alias("depth"),
            F.col("_ended").alias("ended"), F.least("low", "_low").alias("low"))
        rows = written(rows.where("ended").unionByName(moved), "chains")
        steps *= 2
        if steps >= left or not rows.where("not ended").limit(1).count():
            break
    rooted = rows.where("ended").select("id", F.lit("ROOTED").alias("state"), F.col("at").alias("root"), "depth")
    circling = rows.where("not ended")
    members = circling.select("at").distinct()
    # A member has gone round its whole circle, so its lowest unit names the circle.
    named = members.join(circling.select(F.col("id").alias("at"), F.col("low").alias("root")), "at")
    on = members.select(F.col("at").alias("id"), F.lit(True).alias("on"))
    circled = circling.select("id", "at").join(named, "at").join(on, "id", "left")
    state = F.when(F.col("on"), "CYCLE").otherwise("INTO_CYCLE")
    return rooted.unionByName(circled.select("id", state.alias("state"), "root", F.lit(None).cast("long").alias("depth")))


CHAINS_SQL = """WITH RECURSIVE n AS (SELECT u.id, p.id AS up FROM {m_unit} u LEFT JOIN {m_unit} p ON p.id = u.parent AND u.parent NOT IN (0, u.id)),
    walk AS (SELECT id, [id] AS path, false AS again FROM n UNION ALL
             SELECT w.id, list_append(w.path, n.up), list_contains(w.path, n.up) FROM walk w JOIN n ON n.id = w.path[-1] WHERE n.up IS NOT NULL AND NOT w.again),
    last AS (SELECT id, max_by(path, len(path)) AS path, bool_or(again) AS again FROM walk GROUP BY id)
    SELECT id, CASE WHEN NOT again THEN 'ROOTED' WHEN path[-1] = id THEN 'CYCLE' ELSE 'INTO_CYCLE' END AS state,
           CASE WHEN again THEN list_min(path[list_position(path, path[-1]):]) ELSE path[-1] END AS root, CASE
               WHEN NOT again THEN CAST(len(path) - 1 AS BIGINT) END AS depth FROM last"""
AUDIT_SQL = """SELECT CASE WHEN d.parent IS NULL THEN 'null' WHEN d.parent = 0 THEN 'zero' WHEN d.parent = d.id THEN 'self'
    WHEN p.id IS NULL THEN 'orphan' ELSE 'match' END AS reference, count(*) AS n
    FROM (SELECT id, parent FROM {m_departemen} UNION ALL SELECT id + 100, parent + 100 * CAST(parent > 0 AS INT) FROM {m_unit}) d
    LEFT JOIN (SELECT id FROM {m_departemen} UNION ALL SELECT id + 100 FROM {m_unit}) p ON p.id = d.parent GROUP BY ALL"""


def _all_units(t) -> DataFrame:
    """Departments, and the units below them with numbers of their own."""
    own = t.m_unit.select((F.col("id") + 100).alias("id"), F.when(F.col("parent") > 0, F.col("parent") + 100).otherwise(F.col("parent")).alias("parent"))
    return t.m_departemen.select("id", "parent").unionByName(own)


QUERIES = {
    "hierarchy_audit": (lambda t: hierarchy_audit(_all_units(t)), AUDIT_SQL),
    "hierarchy_chains": (lambda t: hierarchy_chains(t.m_unit), CHAINS_SQL),
}
