"""Data quality: contracts compiled into one aggregate, gates, bounds and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.session import literal_rows


def _fractional(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, column: str) -> Column:
    """Null, or not a number in a floating column."""
    col = F.col(column)
    return col.isNull() | F.isnan(col) if _fractional(df, column) else col.isNull()


def unexpected(column: str, allowed: list) -> Column:
    return F.coalesce(~F.col(column).isin(allowed), F.lit(False))


def outside(df: DataFrame, column: str, bounds: dict) -> Column:
    """Beyond a range. Only a range with both ends is checked; a missing value is inside."""
    lo, hi = bounds.get("min"), bounds.get("max")
    if lo is None or hi is None:
        return F.lit(False)
    return ~missing(df, column) & ~F.col(column).between(lo, hi)


def row_rules(df: DataFrame, contract: dict) -> dict[str, Column]:
    """Rules that one row can break by itself, as conditions that hold for a broken row."""
    rules = {f"not_null[{x}]": missing(df, x) for x in contract.get("not_null", []) if x in df.columns}
    for x, allowed in contract.get("allowed_values", {}).items():
        if x in df.columns:
            rules[f"allowed_values[{x}]"] = unexpected(x, allowed)
    for x, bounds in contract.get("ranges", {}).items():
        if x in df.columns:
            rules[f"range[{x}]"] = outside(df, x, bounds)
    return rules


def check_names(contract: dict) -> list[str]:
    names = ["required_columns"]
    for kind, label in [("not_null", "not_null"), ("unique", "unique"), ("allowed_values", "allowed_values"),
                        ("ranges", "range")]:
        names += [f"{label}[{x}]" for x in contract.get(kind, [])]
    return names + (["row_count_tolerance"] if "row_count" in contract else [])


def count_broken(df: DataFrame, contract: dict, by: list[str] | None = None) -> DataFrame:
    """(by…, check, n): rows that break each row rule, all rules in one scan."""
    rules, by = row_rules(df, contract), by or []
    if not rules:
        return df.limit(0).select(*by, F.lit("").alias("check"), F.lit(0).cast("bigint").alias("n"))
    aggs = [F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    cells = [F.struct(F.lit(name).alias("check"), F.col(f"r{i}").alias("n")) for i, name in enumerate(rules)]
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*cells)))


def count_repeats(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """(by…, check, n): rows that repeat an earlier value; repeated nulls count too."""
    by = by or []
    groups = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_c"))
    return groups.groupBy(*by).agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n")).select(
        *by, F.lit(f"unique[{column}]").alias("check"), "n"
    )


def unexpected_values(df: DataFrame, contract: dict) -> DataFrame:
    """(column, value, n): every value outside its allowed set, as rows."""
    rules = {x: a for x, a in contract.get("allowed_values", {}).items() if x in df.columns}
    cells = [
        F.when(unexpected(x, a), F.struct(F.lit(x).alias("column"), F.col(x).cast("string").alias("value")))
        for x, a in rules.items()
    ]
    bad = df.select(F.explode(F.array_compact(F.array(*cells))).alias("_b")).select("_b.*")
    return bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _value_lists(df: DataFrame, contract: dict) -> DataFrame:
    """(check, listed): the distinct unexpected values per column, counted map-side before they meet."""
    lists = unexpected_values(df, contract).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("listed"))
    return lists.select(F.concat(F.lit("allowed_values["), F.col("column"), F.lit("]")).alias("check"), "listed")


def _text(template: str, *parts: Column) -> Column:
    """A text with its {} filled by columns."""
    pieces = template.split("{}")
    out = [F.lit(pieces[0])]
    for part, piece in zip(parts, pieces[1:]):
        out += [part, F.lit(piece)]
    return F.concat(*out)


def validate(
    df: DataFrame, contract: dict, repeats: dict[str, DataFrame] | None = None, row_count: tuple[str, str] | None = None,
    broken: dict[str, int] | None = None,
) -> DataFrame:
    """(ord, check, outcome, detail): one row per check of the contract.

    Row rules share one scan, each unique key is one aggregate, and only rows per check are put together. ``repeats`` may
    hold the repeats of unique columns, as :func:`count_repeats` gives them, where history counts too; ``row_count`` is the
    (outcome, detail) of the row-count rule, which a table alone cannot tell; ``broken`` the counts of the row rules
    where they were taken already.
    """
    spark, names = df.sparkSession, check_names(contract)
    absent = [x for x in contract.get("required_columns", []) if x not in df.columns]
    known = repeats or {}
    counted = literal_rows(spark, list(broken.items()), "check string, n bigint") if broken else count_broken(df, contract)
    for column in contract.get("unique", []):
        if column in df.columns:
            counted = counted.unionByName(known[column] if column in known else count_repeats(df, column))
    has_values = [x for x in contract.get("allowed_values", {}) if x in df.columns]
    if broken:  # values are listed where there are any
        has_values = [x for x in has_values if broken.get(f"allowed_values[{x}]")]
    if has_values:
        counted = counted.unionByName(_value_lists(df, contract), allowMissingColumns=True)
    else:
        counted = counted.withColumn("listed", F.lit(None).cast("array<string>"))
    found = counted.groupBy("check").agg(
        F.sum("n").alias("n"), F.first("listed", ignorenulls=True).alias("listed")
    )

    check = F.col("check")
    limits = F.lit("")
    for x, b in contract.get("ranges", {}).items():
        limits = F.when(check == f"range[{x}]", f"[{b.get('min')},{b.get('max')}]").otherwise(limits)
    values = F.concat(F.lit("['"), F.array_join("listed", "', '"), F.lit("']"))
    n = F.col("n").cast("string")
    whole, broken = F.lit(""), F.lit("")
    for kind, parts in [("not_null", (n,)), ("unique", (n,)), ("allowed_values", (values,)), ("range", (n, limits))]:
        fine, bad = fixed.DETAILS[kind]
        whole = F.when(check.startswith(kind), _text(fine, limits)).otherwise(whole)
        broken = F.when(check.startswith(kind), _text(bad, *parts)).otherwise(broken)
    order = F.lit(0)
    for i, name in enumerate(names):
        order = F.when(check == name, i).otherwise(order)
    data = found.select(
        order.alias("ord"),
        "check",
        F.when(F.col("n") > 0, "fail").otherwise("pass").alias("outcome"),
        F.when(F.col("n") > 0, broken).otherwise(whole).alias("detail"),
    )

    required = contract.get("required_columns", [])
    fine, bad = fixed.DETAILS["required_columns"]
    fixed_rows = [
        (0, "required_columns", "fail" if absent else "pass", bad.format(absent) if absent else fine.format(len(required)))
    ]
    for i, name in enumerate(names):
        column = name.partition("[")[2].rstrip("]")
        if column and column not in df.columns:
            fixed_rows.append((i, name, "fail", fixed.COLUMN_ABSENT))
    if "row_count" in contract:
        fixed_rows.append((len(names) - 1, "row_count_tolerance", *(row_count or ("warn", fixed.NO_HISTORY))))
    return data.unionByName(literal_rows(spark, fixed_rows, "ord int, check string, outcome string, detail string"))


def worst(outcome: Column) -> Column:
    """Aggregate of outcomes: fail before warn before pass."""
    code = F.max(F.when(outcome == "fail", 2).when(outcome == "warn", 1).otherwise(0))
    return F.when(code == 2, "fail").when(code == 1, "warn").otherwise("pass")


def gate(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    return results.groupBy(*(by or [])).agg(worst(F.col("outcome")).alias("outcome"))


def silver_checks(star) -> DataFrame:
    """(stage, outcome, details): keys resolve, amounts are there, no currency is left."""
    txns, loans, names = star.fact_transaction, star.fact_loan, fixed.SILVER_CHECKS

    def rows(df: DataFrame, checks: list[tuple[str, Column, str]]) -> DataFrame:
        counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond, _) in enumerate(checks)])
        cells = [
            F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("n"), F.lit(word).alias("word"))
            for i, (name, _, word) in enumerate(checks)
        ]
        return counts.select(F.inline(F.array(*cells)))

    currency_left = F.lit("currency" in txns.columns)
    found = rows(
        txns,
        [
            (names["txn_account"], F.col("account_sk").isNull(), "unresolved"),
            (names["txn_amount"], F.col("amount_eur").isNull(), "null"),
            (names["no_currency"], currency_left, "rows with a residual currency column"),
        ],
    ).unionByName(rows(loans, [(names["loan_account"], F.col("account_sk").isNull(), "unresolved")]))
    ok = F.col("n") == 0
    return found.select(
        F.lit("silver").alias("stage"),
        F.when(ok, "pass").otherwise("fail").alias("outcome"),
        F.when(ok, F.col("check"))
        .otherwise(F.concat("check", F.lit(": "), F.col("n").cast("string"), F.lit(" "), F.col("word")))
        .alias("details"),
    )


def personal_checks(tables: dict[str, DataFrame], personal: dict[str, tuple[str, ...]]) -> DataFrame:
    """(stage, outcome, details) per source with personal columns: none of them may be left in any of the tables."""
    rows = []
    for source, columns in personal.items():
        left = sorted(f"{t}.{x}" for t, df in tables.items() for x in set(columns) & set(df.columns))
        rows.append(("silver", "fail" if left else "pass", f"{source}: personal columns left: {left}" if left else f"{source}: no personal columns left"))
    spark = next(iter(tables.values())).sparkSession
    return literal_rows(spark, rows, "stage string, outcome string, details string")


def gold_checks(kpi: DataFrame, bounds: dict[str, tuple] = fixed.GOLD_BOUNDS) -> DataFrame:
    """(kpi, value, low, high, outcome) of every KPI row in ``kpi``: missing passes, not-a-number fails."""
    cells = [
        F.struct(
            F.lit(name).alias("kpi"),
            F.col(name).cast("double").alias("value"),
            F.lit(float(lo)).alias("low"),
            F.lit(float(hi)).alias("high"),
        )
        for name, (lo, hi) in bounds.items()
    ]
    v = F.col("value")
    ok = v.isNull() | (~F.isnan(v) & v.between(F.col("low"), F.col("high")))
    return kpi.select("date", F.inline(F.array(*cells))).withColumn(
        "outcome", F.when(ok, "pass").otherwise("fail")
    )


def failed_rules(df: DataFrame, contract: dict) -> DataFrame:
    """Each row with the list of row rules that it breaks."""
    names = [F.when(cond, F.lit(name)) for name, cond in row_rules(df, contract).items()]
    return df.withColumn("failed", F.array_compact(F.array(*names)))


def quarantine(df: DataFrame, contract: dict) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows that break a row rule with the rules they break)."""
    marked = failed_rules(df, contract)
    return marked.where(F.size("failed") == 0).drop("failed"), marked.where(F.size("failed") > 0)


def gate_decision(outcomes: DataFrame) -> DataFrame:
    """What to do after a gate, from (layer, outcome, retries, requested).

    No failure goes on, and so does gold, which never blocks. On a failure an action that is missing or not
    known halts, and a retry after the first escalates.
    """
    asked = F.lower(F.trim("requested"))
    action = (
        F.when((F.col("outcome") != "fail") | (F.col("layer") == "gold"), "proceed")
        .when(asked.isNull() | ~asked.isin(fixed.GATE_ACTIONS), "halt")
        .when((asked == "retry") & (F.col("retries") >= 1), "escalate")
        .otherwise(asked)
    )
    return outcomes.withColumn("action", action)
