"""Versions of a dimension over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per business key, the newest by ``newest``. An aggregate, so a hot key combines map-side."""
    first = [*newest, *[c for c in df.columns if c not in newest and c not in keys]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*first)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def scd2_history(df: DataFrame, key: str, day: str, attrs: list[str], tiebreak: str) -> DataFrame:
    """Versions with effective dates from a log of states.

    The log is first cut to one state per key and day, so a window holds at most one row per calendar day.
    ``valid_to`` is exclusive and null for the current version.
    """
    state = F.struct(*attrs)
    days = df.groupBy(key, day).agg(F.max_by(state, tiebreak).alias("_state"))
    w = Window.partitionBy(key).orderBy(day)
    prior = F.lag("_state").over(w)
    changed = days.withColumn("_new", ~prior.eqNullSafe(F.col("_state"))).where("_new")
    valid_to = F.lead(day).over(w)
    return changed.select(
        key,
        *[F.col(f"_state.{a}").alias(a) for a in attrs],
        F.col(day).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, attrs: list[str], as_of: str) -> DataFrame:
    """Carry a versioned dimension forward by one snapshot; entities absent from it stay as they are."""
    day = F.lit(as_of).cast("date")
    cols = [key, *attrs, "valid_from", "valid_to", "is_current"]
    closed = dim.where(~F.col("is_current")).select(*cols)
    cur = dim.where("is_current").select(key, F.struct(*attrs).alias("_old"), "valid_from")
    new = snapshot.select(key, F.struct(*attrs).alias("_new"))
    both = cur.join(new, key, "full_outer")
    same = F.col("_new").isNull() | F.col("_old").eqNullSafe(F.col("_new"))
    open_ = F.lit(None).cast("date")

    def version(state: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            F.col(state).alias("_state"), start.alias("valid_from"), end.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    versions = (
        F.when(F.col("_old").isNull(), F.array(version("_new", day, open_, True)))
        .when(same, F.array(version("_old", F.col("valid_from"), open_, True)))
        .otherwise(
            F.array(version("_old", F.col("valid_from"), day, False), version("_new", day, open_, True))
        )
    )
    live = both.select(key, F.inline(versions)).select(
        key, *[F.col(f"_state.{a}").alias(a) for a in attrs], "valid_from", "valid_to", "is_current"
    )
    return closed.unionByName(live)


def scd2_splice(
    dim: DataFrame, snapshot: DataFrame, key: str, attrs: list[str], as_of: str, next_day: str | None = None
) -> DataFrame:
    """Put a snapshot between the stored versions: the newest one, one that is corrected, or one that comes late.

    ``next_day`` is the first day after ``as_of`` that was observed already, if any: an entity goes back to its stored
    state there. What starts later stays as it is, and entities absent from the snapshot keep all their versions. The
    versions are read as a log of states, one per key and day, and cut anew; so a repeated call changes nothing.
    """
    day, state = F.lit(as_of).cast("date"), F.struct(*attrs)
    stored = dim.select(key, F.col("valid_from").alias("_on"), "valid_to", state.alias("_s"))
    now = dedup_latest(snapshot.select(key, *attrs), [key], attrs).select(key, state.alias("_s"))
    log = stored.select(key, "_on", "_s", F.lit(0).alias("_rank")).unionByName(
        now.select(key, day.alias("_on"), "_s", F.lit(2).alias("_rank"))
    )
    if next_day:
        later = F.lit(next_day).cast("date")
        covers = (F.col("_on") < later) & (F.col("valid_to").isNull() | (F.col("valid_to") > later))
        back = stored.where(covers).join(now.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        log = log.unionByName(back.select(key, later.alias("_on"), "_s", F.lit(1).alias("_rank")))
    flat = log.select(key, "_on", *[F.col(f"_s.{a}").alias(a) for a in attrs], "_rank")
    return scd2_history(flat, key, "_on", attrs, "_rank")


def scd2_asof(facts: DataFrame, dim: DataFrame, key: str, day: str, attrs: list[str]) -> DataFrame:
    """Join each fact with the version of its dimension row that is valid on the fact's day.

    The version is looked up once per (key, day) that occurs in the facts, by carrying it forward over days:
    a window holds at most two rows per calendar day whatever the number of facts. The facts then take it by
    an equi join on (key, day), which spreads a hot key over its days and leaves the rest to the skew join.
    """
    version = F.struct(*attrs, "valid_from", "valid_to")
    starts = dim.select(key, F.col("valid_from").alias(day), version.alias("_v"), F.lit(0).alias("_is_fact"))
    asked = facts.select(key, day).distinct().withColumn("_v", F.lit(None).cast(starts.schema["_v"].dataType))
    timeline = starts.unionByName(asked.withColumn("_is_fact", F.lit(1)))
    w = Window.partitionBy(key).orderBy(day, "_is_fact").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        timeline.withColumn("_v", F.last("_v", ignorenulls=True).over(w))
        .where("_is_fact = 1")
        .select(
            key, day,
            F.when(
                F.col("_v.valid_to").isNull() | (F.col(day) < F.col("_v.valid_to")), F.col("_v")
            ).alias("_v"),
        )
    )
    out = facts.join(found, [key, day], "left")
    return out.select(
        *facts.columns, *[F.col(f"_v.{a}").alias(a) for a in attrs], F.col("_v.valid_from").alias("valid_from")
    )
