"""KPI measures defined once over the star and evaluated at any grain.

Balances are semi-additive: they add up over accounts, not over days. Without the date among the dimensions a
balance measure therefore takes the last day, while flows take all days. A fact that a dimension does not reach
(loans by channel) shows the same total on every row of it.

Facts are combined to one row per cell of the dimensions first; subtotals and distinct customers come from these cells.
The customers of a cell are bitmaps over their dense keys, so any set of cells counts them exactly by merging bitmaps.
Growth is against exactly one calendar day before, in the same cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators.star import Star, by_keys, txn_channel
from tidemark.session import materialise

ACCOUNT_DIMS = {"product_type", "status"}
CUSTOMER_DIMS = {"segment", "country"}
CHANNEL_DIMS = {"channel", "is_digital"}
REACH = {
    "balance": {"date", *ACCOUNT_DIMS, *CUSTOMER_DIMS},
    "loan": {"date", *ACCOUNT_DIMS, *CUSTOMER_DIMS},
    "txn": {"date", *ACCOUNT_DIMS, *CUSTOMER_DIMS, *CHANNEL_DIMS},
}
SUBTOTALS = ("rollup", "cube")

# measure -> (formula over the parts below, facts that it needs)
MEASURES: dict[str, tuple[Column, set[str]]] = {}


def _define() -> None:
    p = F.col
    MEASURES.update(
        {
            "total_deposits": (p("deposits").cast("double"), {"balance"}),
            "net_loans": (p("loans").cast("double"), {"loan"}),
            "loan_to_deposit_ratio": (c.ratio(p("loans"), p("deposits")), {"balance", "loan"}),
            "net_interest_margin_pct": (c.ratio(p("interest"), p("loans")) * 100, {"txn", "loan"}),
            "fee_income": (p("fee").cast("double"), {"txn"}),
            "transaction_volume": (p("volume").cast("bigint"), {"txn"}),
            "transaction_value": (p("value").cast("double"), {"txn"}),
            "npl_rate_pct": (c.ratio(p("npl"), p("loans")) * 100, {"loan"}),
            "active_customers": (p("active").cast("bigint"), {"txn"}),
            "digital_channel_mix_pct": (c.ratio(p("digital"), p("volume")) * 100, {"txn"}),
            "deposits_growth_pct": (_change(p("deposits"), p("deposits_prior")), {"balance"}),
            "loans_growth_pct": (_change(p("loans"), p("loans_prior")), {"loan"}),
            "net_new_customers": (
                (F.coalesce("active", F.lit(0)) - F.coalesce("active_prior", F.lit(0))).cast("bigint"), {"txn"}
            ),
        }
    )


#: Measures that look one day back, and the part that they compare.
GROWTH = {"deposits_growth_pct": "deposits", "loans_growth_pct": "loans", "net_new_customers": "active"}
ACTIVE = {"active_customers", "net_new_customers"}


def _change(now: Column, before: Column) -> Column:
    return c.ratio(now.cast("double") - before.cast("double"), before) * 100


def _last_day(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("date_sk") == fact.agg(F.max("date_sk").alias("m")).scalar())


def _values(star: Star, fact: str, dated: bool) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of a fact that count, and its additive parts."""
    if fact == "balance":
        rows = star.fact_account_balance if dated else _last_day(star.fact_account_balance)
        return rows, {"deposits": F.when(F.col("is_deposit"), F.col("balance_eur"))}
    if fact == "loan":
        rows, principal = star.fact_loan if dated else _last_day(star.fact_loan), F.col("principal_outstanding_eur")
        return rows, {"loans": principal, "npl": F.when(F.col("is_npl"), principal)}
    amount = F.col("amount_eur")
    return star.fact_transaction, {
        "interest": F.when(F.col("is_interest"), amount),
        "fee": F.when(F.col("is_fee"), -amount),
        "volume": F.lit(1),
        "value": F.abs(amount),
    }


def _with_dims(star: Star, fact: str, by: set[str], measures: list[str], dated: bool) -> DataFrame:
    """The parts of a fact with the dimensions of ``by``. Only dimensions that are asked for are looked up.

    The date stays its key: it is written out once per cell.
    """
    txn = fact == "txn"
    owner = [*(["customer_sk"] if txn and ACTIVE & set(measures) else []),
             *sorted(by & (ACCOUNT_DIMS | CUSTOMER_DIMS))]
    channel = txn and bool(by & CHANNEL_DIMS or "digital_channel_mix_pct" in measures)
    keys = ["date_sk", *([star.account_key] if owner else []), *([star.channel_key] if channel else [])]
    rows, parts = _values(star, fact, dated)
    out = by_keys(star, rows, keys, parts, sparse=bool(owner) and not txn)
    if owner:
        out = out.join(star.owners(*owner), star.account_key, "left")
    if channel:
        out = txn_channel(out, star.dim_channel, star.channel_key)
    return out


def _parts(fact: str, measures: list[str]) -> list[Column]:
    """Additive parts of a cell."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    if fact == "balance":
        return [total("deposits")]
    if fact == "loan":
        return [F.sum("loans").alias("loans"), total("npl")]
    out = [total(x) for x in ["interest", "fee", "volume", "value"]]
    if "digital_channel_mix_pct" in measures:
        out.append(F.sum(F.when(F.col("is_digital"), F.col("volume")).otherwise(0)).alias("digital"))
    return out


def customer_bits(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by…, bucket, bits): the customers of each cell as bitmaps over their dense keys, combined map-side."""
    key = F.col("customer_sk")
    return rows.where(key.isNotNull()).groupBy(*by, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
    )


def count_bits(bits: DataFrame, by: list[str], subtotals: str | None = None) -> DataFrame:
    """(by…, active): distinct customers, exact, from stored or fresh bitmaps of any finer cells.

    With ``subtotals`` the cells are rolled up or cubed, and ``level`` is the grouping id; only cells are expanded.
    """
    if not subtotals:
        merged = bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("active"))
    cells = bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sets = [[F.col(x) for x in kept] + [F.col("bucket")] for kept in _grouping_sets(by, subtotals)]
    merged = cells.groupingSets(sets, *by, "bucket").agg(
        F.shiftright(F.grouping_id(), 1).cast("int").alias("level"), F.bitmap_or_agg("bits").alias("bits")
    )
    return merged.groupBy(*by, "level").agg(F.sum(F.bitmap_count("bits")).alias("active"))


def _grouping_sets(by: list[str], subtotals: str) -> list[list[str]]:
    if subtotals == "rollup":
        return [by[:n] for n in range(len(by), -1, -1)]
    return [[x for k, x in enumerate(by) if pick >> k & 1] for pick in range(2 ** len(by))]


def _with_day_before(cells: DataFrame, dims: list[str], parts: list[str]) -> DataFrame:
    """Cells on the grid of all their days and all other dimension values, with each part of the calendar day before."""
    other = [d for d in dims if d != "date"]
    cells = materialise(cells, "cells")  # read three times below, worked out once
    days = cells.agg(F.collect_set("date").alias("days")).scalar()  # calendar days
    grid = cells.select(*other).distinct() if other else cells.limit(1).select(F.lit(1).alias("_one"))
    grid = grid.withColumn("date", F.explode(days)).select(*[F.col(d).alias(f"_{d}") for d in dims])
    same = [F.col(f"_{d}").eqNullSafe(F.col(d)) for d in dims]
    full = grid.join(cells, same, "left").drop(*dims).withColumnsRenamed({f"_{d}": d for d in dims})
    w = Window.partitionBy(*other).orderBy(F.unix_date(F.col("date").cast("date"))).rangeBetween(-1, -1)
    return full.withColumns({f"{x}_prior": F.first(x).over(w) for x in parts})


def evaluate(star: Star, measures: list[str], dims: list[str], subtotals: str | None = None) -> DataFrame:
    """One row per combination of ``dims`` with the measures as columns.

    ``subtotals`` is ``rollup`` or ``cube``; then ``level`` is the grouping id and the date may not be among the
    dimensions, since balances do not add up over days. Growth measures need the date; with one of them every cell has
    a row on every day that any cell has. Growth is null where the day before has no value; net new customers count an
    absent day as nobody.
    """
    if not MEASURES:
        _define()
    growth = {GROWTH[m] for m in measures if m in GROWTH}
    if growth and "date" not in dims:
        raise ValueError("growth measures need the date among the dimensions")
    facts = sorted(set().union(*[MEASURES[m][1] for m in measures]))
    wide = [f for f in facts if set(dims) <= REACH[f]]
    narrow = [f for f in facts if f not in wide]
    if not wide:
        raise ValueError(f"no fact of {measures} is reached by all of {dims}")
    if subtotals and (subtotals not in SUBTOTALS or "date" in dims or narrow):
        raise ValueError("subtotals need dimensions other than the date that reach every fact")

    def grouped(fact: str, by: list[str]) -> DataFrame:
        rows, parts = _with_dims(star, fact, set(by), measures, "date" in dims), _parts(fact, measures)
        if "date" not in by:
            return combined(fact, rows, by, parts)
        cells = combined(fact, rows, ["date_sk" if x == "date" else x for x in by], parts)
        return cells.withColumn("date", c.iso(c.sk_to_date(F.col("date_sk")))).drop("date_sk")

    def combined(fact: str, rows: DataFrame, by: list[str], parts: list[Column]) -> DataFrame:
        cells = rows.groupBy(*by).agg(*parts)
        if subtotals:
            sums = [F.sum(x).alias(x) for x in cells.columns if x not in by]
            cells = getattr(cells, subtotals)(*by).agg(F.grouping_id().cast("int").alias("level"), *sums)
        if fact == "txn" and ACTIVE & set(measures):
            nobody = cells.withColumn("active", F.lit(0).cast("bigint"))
            found = count_bits(customer_bits(rows, by), by, subtotals)
            return nobody.unionByName(found, allowMissingColumns=True)
        return cells

    keys = [*dims, "level"] if subtotals else dims
    out = grouped(wide[0], dims)
    for fact in wide[1:]:
        out = out.unionByName(grouped(fact, dims), allowMissingColumns=True)
    def folded(df: DataFrame, by: list[str]) -> DataFrame:
        return df.groupBy(*by).agg(*[F.sum(x).alias(x) for x in df.columns if x not in by])

    out = folded(out, keys)
    for fact in narrow:
        by = [d for d in dims if d in REACH[fact]]
        side = folded(grouped(fact, by), by)
        if not by:
            out = out.withColumns({x: side.select(x).scalar() for x in side.columns})
        else:
            other = side.withColumnsRenamed({d: f"_{d}" for d in by})
            on = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in by]
            out = out.join(other, on, "left").drop(*[f"_{d}" for d in by])
    if growth:
        out = _with_day_before(out, dims, sorted(growth))
    return out.select(*keys, *[MEASURES[m][0].alias(m) for m in measures])
