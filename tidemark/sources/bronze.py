"""Landing of sources in bronze, with lineage and one batch per business day."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.sources.lake import Lake

LINEAGE = ["_ingested_at", "_source_system", "_batch_id", "_run_id", "_source_file"]


@dataclass(frozen=True)
class SourceConfig:
    source_id: str
    domain: str
    read: Callable[[], DataFrame]
    read_mode: str
    watermark: str
    target: str
    pii: tuple[str, ...] = ()
    contract: str | None = None


def add_lineage(
    df: DataFrame, source_id: str, batch_id: str | Column, run_id: str, source_file: Column | None = None
) -> DataFrame:
    """Stamp the five lineage columns. The default origin is the source's name; pass
    ``F.col('_metadata.file_path')`` for the file of a direct file scan."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_system": F.lit(source_id),
            "_batch_id": F.lit(batch_id) if isinstance(batch_id, str) else batch_id,
            "_run_id": F.lit(run_id),
            "_source_file": F.lit(f"source://{source_id}") if source_file is None else source_file,
        }
    )


def incremental_window(df: DataFrame, watermark: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Rows of the business days from first to last. Bounds on the raw column reach the file scan."""
    ts = F.col(watermark)
    end = F.date_add(F.lit(last_day or first_day).cast("date"), 1)
    return df.where((ts >= F.lit(first_day).cast("date")) & (ts < end))


@dataclass
class Landed:
    """What the writes of a landing saw: rows per target table, and per source the rows that break each row rule."""

    rows: dict[str, int] = field(default_factory=dict)
    by_source: dict[str, int] = field(default_factory=dict)
    broken: dict[str, dict[str, int]] = field(default_factory=dict)


def _watched(df: DataFrame, contract: dict | None) -> tuple[DataFrame, Observation | None, list[str]]:
    """``df`` with the counts of its contract's row rules observed as it is written."""
    rules = quality.row_rules(df, contract) if contract else {}
    if not rules:
        return df, None, []
    seen = Observation()
    counts = [F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    return df.observe(seen, *counts), seen, list(rules)


def _land_days(lake: Lake, cfg: SourceConfig, df: DataFrame, run_id: str, first: str, last: str) -> int:
    """Every day of the window becomes a batch in one job; a day that has no rows gets an empty batch.

    The window is read once: the write itself notes the days that it sees, as a bitmap of day numbers.
    """
    if first == last:
        batch = f"{cfg.source_id}:{first}"
        return lake.write(cfg.target, add_lineage(df, cfg.source_id, batch, run_id), "append", batch)
    day, start, seen = F.date_format(cfg.watermark, "yyyy-MM-dd"), date.fromisoformat(first), Observation()
    number = F.datediff(F.to_date(F.col(cfg.watermark)), F.lit(first).cast("date"))
    batch = F.concat(F.lit(cfg.source_id + ":"), day)
    rows = lake.write(
        cfg.target, add_lineage(df, cfg.source_id, batch, run_id), "append", batch,
        seen, F.bitmap_construct_agg(number.cast("bigint")).alias("days"),
    )
    bits = seen.get["days"] or b""
    for n in range((date.fromisoformat(last) - start).days + 1):
        if n // 8 >= len(bits) or not bits[n // 8] >> n % 8 & 1:
            name = f"{cfg.source_id}:{start + timedelta(n)}"
            lake.write(cfg.target, add_lineage(df.limit(0), cfg.source_id, name, run_id), "append", name)
    return rows


MARKS = "ops.marks"


def land_since(lake: Lake, cfg: SourceConfig, run_id: str, until: str, lookback: int = 7) -> list[str]:
    """Land what came since the stored mark of a source, up to the day ``until``; returns the days that were written.

    The days from ``lookback`` days before the mark on are read once and compared with what is known of each by its rows
    and a digest over them; only days that differ are written, each replacing its batch. So a late or corrected row of an
    old day lands in its batch once, and a call without news writes nothing. Without a mark everything is read. The days
    and digests of the lookback are what reaches the driver.
    """
    df, day = cfg.read(), F.date_format(cfg.watermark, "yyyy-MM-dd")
    known: dict[str, tuple] = {}
    if lake.exists(MARKS):
        marks = lake.scan(MARKS).where(F.col("source_id") == cfg.source_id).groupBy("date")
        marks = marks.agg(F.max_by(F.struct("n", "digest"), "at").alias("m")).select("date", "m.*")
        newest = marks.agg(F.max("date")).first()[0]
        if newest:
            first = (date.fromisoformat(newest) - timedelta(lookback)).isoformat()
            df = df.where(F.col(cfg.watermark) >= F.lit(first).cast("date"))
            known = {r.date: (r.n, r.digest) for r in marks.where(F.col("date") >= first).collect()}
    df = df.where(F.col(cfg.watermark) < F.date_add(F.lit(until).cast("date"), 1))
    digest = F.bit_xor(F.xxhash64(*[F.col(x).cast("string") for x in df.columns]))
    seen = {r.date: (r.n, r.digest) for r in df.groupBy(day.alias("date")).agg(F.count("*").alias("n"), digest.alias("digest")).collect()}
    changed = sorted(d for d in {*seen, *known} if seen.get(d) != known.get(d))
    if not changed:
        return []
    batch = F.concat(F.lit(cfg.source_id + ":"), day)
    lake.write(cfg.target, add_lineage(df.where(day.isin(changed)), cfg.source_id, batch, run_id), "append", batch)
    for gone in [d for d in changed if d not in seen]:  # every row of the day was taken back
        name = f"{cfg.source_id}:{gone}"
        lake.write(cfg.target, add_lineage(df.limit(0), cfg.source_id, name, run_id), "append", name)
    rows = [(cfg.source_id, d, *seen.get(d, (0, None)), time.time_ns()) for d in changed]
    frame = lake.spark.createDataFrame(rows, "source_id string, date string, n long, digest long, at long").coalesce(1)
    lake.write(MARKS, frame, "append", f"{cfg.source_id}:{run_id}")  # the newest mark of a day counts
    return changed


def land(
    lake: Lake,
    sources: list[SourceConfig],
    lookups: dict[str, DataFrame],
    run_id: str,
    first_day: str,
    last_day: str | None = None,
    contracts: dict | None = None,
) -> Landed:
    """Land every source and lookup; returns what the writes saw, lookups not counted.

    An incremental source is appended with one batch per business day of the window, all in one job;
    a full source replaces its table. With ``contracts`` the row rules are counted by the same writes. Sources that
    share a target add up.
    """
    out = Landed()
    last = last_day or first_day
    for cfg in sources:
        df, contract = cfg.read(), (contracts or {}).get(cfg.contract)
        if cfg.read_mode == "incremental":
            df, seen, names = _watched(incremental_window(df, cfg.watermark, first_day, last), contract)
            n = _land_days(lake, cfg, df, run_id, first_day, last)
        else:
            batch = f"{cfg.source_id}:{last}"
            df, seen, names = _watched(df, contract)
            n = lake.write(cfg.target, add_lineage(df, cfg.source_id, batch, run_id), "overwrite", batch)
        out.rows[cfg.target] = out.rows.get(cfg.target, 0) + n
        out.by_source[cfg.source_id] = n
        if seen:
            found = seen.get if n else {}
            out.broken[cfg.source_id] = {name: found.get(f"r{i}", 0) for i, name in enumerate(names)}
    for name, df in lookups.items():
        lake.write(f"bronze.{name}", add_lineage(df, name, run_id, run_id), "overwrite", run_id)
    return out
