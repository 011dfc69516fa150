"""Global order without a global task: dense keys and running totals that no hot key can pile up.

Rows are range-partitioned by a unique order and stored with their slice number and their position in it.
What crosses slices is one small row per slice, so nothing longer than the number of slices is collected or
broadcast.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

SLICE, POS = "_slice", "_pos"
POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def ordered_slices(df: DataFrame, order: list[str | Column], slices: int | None = None) -> DataFrame:
    """Store ``df`` in slices that follow each other in ``order``, with slice number and position from 0.

    ``order`` should be unique: then equal runs give equal positions. The write fixes the range bounds,
    which come from sampling. Without a number of slices a small table is coalesced to few.
    """
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).withColumn("_rid", F.monotonically_increasing_id())
    return materialise(
        ranged.withColumns(
            {
                SLICE: F.shiftright("_rid", POSITION_BITS).cast("int"),
                POS: F.col("_rid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
            }
        ).drop("_rid"),
        "slices",
    )


def dense_key(df: DataFrame, order: list[str | Column], name: str, slices: int | None = None) -> DataFrame:
    """Add 1..n in ``order``: the position in the slice plus the rows of the slices before it.

    Only the row counts of the slices reach the driver, one number each.
    """
    rows = ordered_slices(df, order, slices)
    counts = {r[SLICE]: r["count"] for r in rows.groupBy(SLICE).count().collect()}
    before = list(accumulate((counts.get(i, 0) for i in range(max(counts, default=0))), initial=0))
    offset = F.element_at(F.lit(before).cast("array<bigint>"), F.col(SLICE) + 1)
    return rows.select((offset + F.col(POS) + 1).alias(name), *df.columns)


def stable_key(
    df: DataFrame, stored: DataFrame | None, natural: str, name: str, slices: int | None = None
) -> DataFrame:
    """Keep the keys already given out in ``stored``; entities not seen before follow after the greatest."""
    if stored is None:
        return dense_key(df, [natural], name, slices)
    known = stored.select(natural, name)
    new = dense_key(df.join(known, natural, "left_anti"), [natural], name, slices)
    top = F.coalesce(known.agg(F.max(name).alias("m")).scalar(), F.lit(0))
    old = df.join(known, natural).select(name, *df.columns)
    return old.unionByName(new.withColumn(name, F.col(name) + top))


DAY_KEYS = 10**11  # keys per day; the day in front fills the rest of a bigint


def day_key(df: DataFrame, order: list[str | Column], name: str, slices: int | None = None) -> DataFrame:
    """Key of a fact stored day by day: its date key in front, its position in the day behind.

    Unique over all days without a look at the others, and the same again when a day is rebuilt.
    ``df`` holds one day, of fewer than DAY_KEYS rows; a longer one is an error.
    """
    place = F.col(name)
    sound = F.when(place < DAY_KEYS, place).otherwise(F.raise_error(F.lit(f"a day of {DAY_KEYS} rows or more")))
    return dense_key(df, order, name, slices).withColumn(name, F.col("date_sk").cast("bigint") * DAY_KEYS + sound)


def running_sum(
    df: DataFrame, key: str, order: list[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """Running total of ``value`` per key in ``order``; a key may span any number of slices, the null key too."""
    rows = ordered_slices(df, [key, *order], slices)
    kind = "decimal(38,2)"
    parts = rows.groupBy(key, SLICE).agg(F.sum(value).cast(kind).alias("_part"))
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # only the first key of a slice can have rows in an earlier slice: at most one carry per slice
    carries = (
        parts.withColumn("_carry", F.sum("_part").over(earlier).cast(kind))
        .where(F.col("_carry").isNotNull())
        .select(key, SLICE, "_carry")
    )
    within = Window.partitionBy(SLICE, key).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(value).over(within).cast(kind) + F.coalesce("_carry", F.lit(0).cast(kind))
    carries = carries.toDF("_key", "_at", "_carry")
    same = rows[key].eqNullSafe(carries["_key"]) & (rows[SLICE] == carries["_at"])
    return rows.join(F.broadcast(carries), same, "left").select(*df.columns, total.cast(kind).alias(name))
