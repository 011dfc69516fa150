"""Report data: latest rows, cards, lines, bars, whole templates, routing of requests, dashboard and briefing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.plans.kpi import kpi_long
from tidemark.session import literal_rows


def latest_date_rows(df: DataFrame) -> DataFrame:
    """Rows of the greatest date, compared as text; a table without a date stays whole."""
    if "date" not in df.columns:
        return df
    day = F.col("date").cast("string")
    return df.where(day == df.agg(F.max(day).alias("m")).scalar())


def source_filter(df: DataFrame, source: str | None) -> DataFrame:
    return df.where(F.col("source") == source) if source and "source" in df.columns else df


def sum_by_dim(df: DataFrame, x: str, y: str) -> DataFrame:
    """Latest date, grouped by x, sum of y."""
    rows = latest_date_rows(df).where(F.col(x).isNotNull())
    return rows.groupBy(F.col(x).cast("string").alias("x")).agg(
        F.sum(F.col(y).cast("decimal(38,6)")).cast("double").alias("value")
    )


def cards(df: DataFrame, fields: list[str]) -> DataFrame:
    """(series, value) of the newest row; fields that the table lacks are skipped.

    Of several rows of the newest date, or of a table without dates, the one with the greatest values counts, field by field.
    """
    present = [f for f in fields if f in df.columns]
    order = [F.desc(x) for x in dict.fromkeys([*(["date"] if "date" in df.columns else []), *present])]
    newest = df.orderBy(*order).limit(1)
    return newest.select(*[F.col(f).cast("double").alias(f) for f in present]).unpivot(
        [], present, "series", "value"
    )


def line(df: DataFrame, x: str, series: list[str]) -> DataFrame:
    """(series, x, value): one series per column; columns that the table lacks are skipped."""
    present = [s for s in series if s in df.columns]
    wide = df.select(F.col(x).cast("string").alias("x"), *[F.col(s).cast("double").alias(s) for s in present])
    return wide.unpivot(["x"], present, "series", "value")


def _visual(df: DataFrame, visual: tuple) -> DataFrame | None:
    """(type, series, x, value) of one visual; None when none of its columns is there."""
    kind, none = visual[0], F.lit(None).cast("string")
    if kind == "kpi_cards":
        if not any(f in df.columns for f in visual[2]):
            return None
        out = cards(df, visual[2]).withColumn("x", none)
    elif kind == "line":
        if not any(s in df.columns for s in visual[3]):
            return None
        out = line(df, visual[2], visual[3])
    elif kind in ("bar", "donut"):
        if visual[3] not in df.columns:
            return None
        out = sum_by_dim(df, visual[2], visual[3]).withColumn("series", F.lit(visual[3]))
    else:
        raise ValueError(f"unknown visual type {kind!r}")
    return out.select(F.lit(kind).alias("type"), "series", "x", "value")


def resolve(gold: dict[str, DataFrame], template: dict, source: str | None = None) -> DataFrame:
    """All visuals of a template as one long table (template, visual, type, series, x, value).

    A table that is absent, lacks the column, or has no rows gives one row of type ``empty``.
    """
    spark, out = next(iter(gold.values())).sparkSession, None
    for i, visual in enumerate(template["visuals"], start=1):
        name = visual[1]
        if not name.startswith("gold."):
            raise ValueError(f"template {template['id']!r} binds outside gold: {name}")
        body, df = None, gold.get(name)
        if df is not None:
            scoped = template.get("by_source") and visual[-1] is True
            df = source_filter(df, source) if scoped else df
            body = _visual(df, visual)
        empty = literal_rows(spark, [("empty", name, None, None)], "type string, series string, x string, value double")
        if body is None:
            body = empty
        else:  # decided when the plan runs: one job for all visuals
            body = body.unionByName(empty.where(df.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar() == 0))
        rows = body.select(F.lit(template["id"]).alias("template"), F.lit(i).alias("visual"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def resolve_all(gold: dict[str, DataFrame], source: str, templates: list[dict] = fixed.TEMPLATES) -> DataFrame:
    out = None
    for template in templates:
        rows = resolve(gold, template, source if template.get("by_source") else None)
        out = rows if out is None else out.unionByName(rows)
    return out


# routing -------------------------------------------------------------------------------------------------


def named_source(text: Column) -> Column:
    """The first known business source in a lower-case text, with or without its final s."""
    hits = [F.when(text.contains(s.rstrip("s")), s) for s in fixed.KNOWN_SOURCES]
    return F.coalesce(*hits)


def route_requests(
    requests: DataFrame, text: str = "request", templates: list[dict] = fixed.TEMPLATES
) -> DataFrame:
    """Add the template, its score and the source for each request.

    Keywords match as substrings. Every score is an expression on the request itself, so nothing is joined;
    the first template wins a tie.
    """
    low = F.col("_low")
    scored = []
    for i, t in enumerate(templates):
        hits = [low.contains(k) for k in [*t["keywords"], t["domain"]]]
        if t.get("by_source"):
            hits.append(F.col("_source").isNotNull())
        score = sum((h.cast("int") for h in hits[1:]), hits[0].cast("int"))
        scored.append(
            F.struct(
                score.alias("score"), F.lit(-i).alias("rank"), F.lit(t["id"]).alias("template"),
                F.lit(t["domain"]).alias("domain"), F.lit(bool(t.get("by_source"))).alias("by_source"),
            )
        )
    best = F.array_max(F.array(*scored))
    routed = requests.withColumn("_low", F.lower(F.col(text))).withColumn("_source", named_source(low))
    source = F.when(
        F.col("_best.by_source"), F.coalesce(F.col("_source"), F.lit(fixed.KNOWN_SOURCES[0]))
    )
    return routed.withColumn("_best", best).select(
        *requests.columns, "_best.template", "_best.domain", "_best.score", source.alias("source")
    )


# dashboard and briefing ----------------------------------------------------------------------------------


def dashboard_series(gold: dict[str, DataFrame]) -> DataFrame:
    """The data of the dashboard as (section, name, x, value): latest row, series and drill-downs."""
    kpi = gold["gold.kpi_daily"]
    latest = cards(kpi, fixed.KPI_COLUMNS).select(
        F.lit("latest").alias("section"), F.col("series").alias("name"), F.lit(None).cast("string").alias("x"), "value"
    )
    series = kpi_long(kpi, fixed.DASHBOARD_SERIES).select(
        F.lit("series").alias("section"), F.col("kpi").alias("name"), F.col("date").alias("x"),
        F.round("value", 2).alias("value"),
    )
    out = latest.unionByName(series)
    for table, x, ys in [
        ("deposits_by_segment", "segment", ["deposits_eur"]),
        ("txn_by_channel", "channel", ["txn_count", "txn_value_eur"]),
        ("loans_by_status", "status", ["principal_outstanding_eur"]),
    ]:
        rows = line(latest_date_rows(gold[f"gold.{table}"]), x, ys)
        out = out.unionByName(rows.select(F.lit(table).alias("section"), F.col("series").alias("name"), "x", "value"))
    return out


def dashboard_json(gold: dict[str, DataFrame]) -> DataFrame:
    """The dashboard as one JSON document per section; a section holds at most a few values per day."""
    point = F.struct("x", "value")
    named = dashboard_series(gold).groupBy("section", "name").agg(F.array_sort(F.collect_list(point)).alias("points"))
    return named.groupBy("section").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "points"))))).alias("json")
    )


def briefing_context(kpi: DataFrame, qa: DataFrame, columns: list[str], days: int = 7) -> DataFrame:
    """Per day: its KPIs, the rows of up to ``days`` days and the notes of checks that warned or failed, as JSON.

    ``qa`` has (date, stage, outcome, details). Everything collected is a few rows per day.
    """
    row = F.struct("date", *columns)
    w = Window.orderBy("date").rowsBetween(1 - days, 0)
    notes = (
        qa.where(F.col("outcome").isin("warn", "fail"))
        .groupBy("date")
        .agg(F.array_sort(F.collect_list(F.concat("stage", F.lit(": "), "details"))).alias("_notes"))
    )
    return (
        kpi.withColumn("today", F.to_json(row))
        .withColumn("history", F.to_json(F.collect_list(row).over(w)))
        .join(notes, "date", "left")
        .select("date", "today", "history", F.coalesce(F.to_json("_notes"), F.lit("[]")).alias("qa_notes"))
    )
