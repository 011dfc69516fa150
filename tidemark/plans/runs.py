"""A daily run over the lake, and run manifests as tables."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import columns as c
from tidemark.operators import history, quality, star as s
from tidemark.operators.keys import registered
from tidemark.operators.slices import day_key
from tidemark.plans import kpi as k
from tidemark.plans import measures
from tidemark.session import materialise
from tidemark.sources import stats
from tidemark.sources.bronze import SourceConfig, land
from tidemark.sources.lake import BATCH, Lake

ACTIVE_BITS = "gold.active_customer_bits"  # the active customers of each day and cell, as bitmaps
UNEXPECTED = "ops.unexpected_values"  # table of every value outside its allowed set
MANIFEST = (
    "run_id string, trigger string, window_from string, window_to string, sources array<string>, "
    "stages map<string,string>, "
    "qa array<struct<stage:string,outcome:string,details:string,checked_at:string>>, "
    "audit array<struct<actor:string,action:string,rows:bigint,duration_s:double,outcome:string,note:string,"
    "at:string>>, status string"
)
LOOKUP_BATCH = "current"
DIMS = ("dim_customer", "dim_account", "dim_channel", "dim_product")
DIM_KEYS = {"dim_customer": "customer_sk", "dim_account": "account_sk", "dim_channel": "channel_sk", "dim_product": "product_sk"}
#: Dimensions that keep versions: their key and the attributes that make a version.
VERSIONED = {
    "dim_customer": ("customer_sk", ["customer_id", "customer_token", "segment", "country"]),
    "dim_account": ("account_sk", ["account_id", "customer_sk", "product_type", "status"]),
}
FACTS = ("fact_transaction", "fact_account_balance", "fact_loan")


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass
class Run:
    run_id: str
    day: str
    sources: list[str]
    trigger: str
    stages: dict[str, str] = field(default_factory=lambda: dict.fromkeys(["extract", "transform", "aggregate"], "pending"))
    qa: list[tuple] = field(default_factory=list)
    audit: list[tuple] = field(default_factory=list)
    status: str = "running"

    def step(self, stage: str, actor: str, work) -> int:
        """Do a stage and record its rows and time, also when it fails."""
        self.stages[stage], started = "running", time.perf_counter()
        try:
            rows = work()
        except Exception as exc:
            spent = round(time.perf_counter() - started, 3)
            self.audit.append((actor, stage, None, spent, "error", f"{type(exc).__name__}", _now()))
            self.stages[stage], self.status = "failed", "failed"
            raise
        self.audit.append((actor, stage, rows, round(time.perf_counter() - started, 3), "ok", "", _now()))
        self.stages[stage] = "passed"
        return rows

    def check(self, results: DataFrame, attempt: int) -> str:
        """Record (stage, outcome, details) rows, a few per gate, and return the worst outcome."""
        rows = results.select("stage", "outcome", "details").collect()
        self.qa += [(r.stage, r.outcome, r.details, _now()) for r in rows]
        outcomes = {r.outcome for r in rows}
        worst = next((x for x in ("fail", "warn") if x in outcomes), "pass")
        self.audit.append(("validation", f"gate:{rows[0].stage if rows else ''}", None, None, worst, f"attempt {attempt}", _now()))
        return worst

    def save(self, spark: SparkSession, path: str) -> None:
        row = (
            self.run_id, self.trigger, self.day, self.day, self.sources, self.stages, self.qa, self.audit, self.status
        )
        folder = f"{path}/{self.run_id.replace(':', '-')}"
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").json(folder)


def row_count_rule(lake: Lake, source: str, day: str, rule: dict) -> tuple[str, str] | None:
    """(outcome, detail) of the row-count rule from the kept counts; None while there is no earlier day."""
    known = stats.counts(lake, source).where(F.col("date") <= day)
    today = k.trailing_counts(known, rule["tolerance_pct"], rule["tolerance_pct"]).where(F.col("date") == day).first()
    if today is None or today.trailing_avg is None:
        return None
    text = f"{today.n} rows, {today.deviation_pct} % from the mean {today.trailing_avg:.1f} of the days before"
    return today.outcome, text


def bronze_gate(
    lake: Lake, sources: list[SourceConfig], contracts: dict, day: str, broken: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """(stage, outcome, details): one row per source with a contract, over the batch that the run landed.

    Keys are unique over all batches: those of an incremental source are looked up in the index of the others. Rows per
    day are held against the kept counts. ``broken`` are the rows against each row rule that the landing counted as it
    wrote; without them the batch is read for it. Every unexpected value goes to UNEXPECTED, a batch per source and day.
    """
    out = None
    for cfg in sources:
        if not cfg.contract:
            continue
        batch, contract = f"{cfg.source_id}:{day}", contracts[cfg.contract]
        landed = lake.scan(cfg.target, keep_batch=True).where(F.col(BATCH) == batch).drop(BATCH)
        if set(contract.get("allowed_values", {})) & set(landed.columns):
            values = quality.unexpected_values(landed, contract).select(F.lit(cfg.source_id).alias("source_id"), "*")
            lake.write(UNEXPECTED, values, "append", batch)
        repeats = {}
        if cfg.read_mode == "incremental":
            for column in set(contract.get("unique", [])) & set(landed.columns):
                stats.keep_keys(lake, cfg.source_id, column, landed, batch)
                repeats[column] = stats.repeats(lake, cfg.source_id, cfg.target, column, batch)
        counted = row_count_rule(lake, cfg.source_id, day, contract["row_count"]) if "row_count" in contract else None
        checks = quality.validate(landed, contract, repeats, counted, (broken or {}).get(cfg.source_id))
        failed = F.when(F.col("outcome") == "fail", F.concat("check", F.lit(": "), "detail"))
        row = checks.agg(
            quality.worst(F.col("outcome")).alias("outcome"),
            F.array_join(F.array_sort(F.collect_list(failed)), "; ").alias("_fails"),
            F.count(F.lit(1)).alias("_n"),
        ).select(
            F.lit(f"bronze:{cfg.source_id}").alias("stage"),
            "outcome",
            F.when(F.col("_fails") != "", F.col("_fails"))
            .otherwise(F.concat(F.col("_n").cast("string"), F.lit(" checks ok")))
            .alias("details"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _sk(day: str) -> int:
    return int(day.replace("-", ""))


def _with_departed(lake: Lake, name: str, today: DataFrame, key: str, day: str) -> DataFrame:
    """Today's rows of a dimension, and the rows of entities that left, closed on the first day without them.

    So every key that a stored fact holds still reaches its row.
    """
    if not lake.exists(name):
        return today
    old = lake.scan(name).join(today.select(key), key, "left_anti")
    gone = F.coalesce("valid_to", F.lit(day).cast("date"))
    old = old.withColumns({"valid_to": gone, "is_current": F.lit(False)})
    return materialise(today.unionByName(old.select(*today.columns)), name.partition(".")[2])


def write_history(lake: Lake, name: str, today: DataFrame, key: str, attrs: list[str], day: str) -> int:
    """The versions of a dimension with the state of a day in its place, also when the day comes late or again."""
    table, later = f"{name}_history", None
    if not lake.exists(table):
        first = today.select(key, *attrs, F.lit(day).cast("date").alias("_on"), F.lit(0).alias("_rank"))
        return lake.write(table, history.scd2_history(first, key, "_on", attrs, "_rank"), "overwrite", LOOKUP_BATCH)
    if lake.exists("silver.dim_date"):
        later = lake.scan("silver.dim_date").where(F.col("date_sk") > _sk(day)).agg(c.iso(F.min("date"))).first()[0]
    versions = history.scd2_splice(lake.scan(table), today, key, attrs, day, later)
    return lake.write(table, materialise(versions, "versions"), "overwrite", LOOKUP_BATCH)


def write_silver(lake: Lake, run: Run, salt: str, txn_batch: str, rates: DataFrame | None = None) -> int:
    """Dimensions with the keys they have for good, their versions, and the facts of the run's day by ``date_sk``.

    Of the postings only the folder of ``txn_batch`` is read, and of the stored facts only those of the day. Entities
    that are absent today keep their rows in the dimensions.
    """
    today = s.build(
        customers=lake.scan("bronze.customers"),
        accounts=lake.scan("bronze.accounts"),
        account_snapshots=lake.scan("bronze.accounts"),
        loan_snapshots=lake.scan("bronze.loans"),
        transactions=lake.scan("bronze.transactions", keep_batch=True).where(F.col(BATCH) == txn_batch),
        channels=lake.scan("bronze.reference_channels").select("channel", "is_digital"),
        products=lake.scan("bronze.reference_products").select("product_type", "product_name"),
        salt=salt,
        as_of=run.day,
        keys=registered(lake),
        rates=rates,
    )
    later = newer_day(lake, run.day)
    dims = {n: getattr(today, n) for n in DIMS}
    rows = 0
    for name, (key, attrs) in VERSIONED.items():
        rows += write_history(lake, f"silver.{name}", dims[name], key, attrs, run.day)
    if later:  # a late or corrected day leaves the newest state of the dimensions, and adds what only it knows
        for name, key in DIM_KEYS.items():
            if lake.exists(f"silver.{name}"):
                newest = lake.scan(f"silver.{name}")
                dims[name] = materialise(
                    newest.unionByName(dims[name].join(newest.select(key), key, "left_anti").select(*newest.columns)), name
                )
    else:
        dims = {n: _with_departed(lake, f"silver.{n}", d, DIM_KEYS[n], run.day) if n in VERSIONED else d for n, d in dims.items()}
    star = s.keyed(replace(today, **dims))
    facts = {
        "fact_transaction": day_key(star.fact_transaction, ["txn_id"], "txn_sk"),
        "fact_account_balance": star.fact_account_balance,
        "fact_loan": day_key(star.fact_loan, ["loan_id"], "loan_sk"),
    }
    rows += sum(lake.write_days(f"silver.{n}", fact, "date_sk", _sk(run.day)) for n, fact in facts.items())
    rows += sum(lake.write(f"silver.{n}", d, "overwrite", LOOKUP_BATCH) for n, d in dims.items())
    dates = stored_star(lake, run.day).dim_date
    if lake.exists("silver.dim_date"):
        dates = materialise(lake.scan("silver.dim_date").unionByName(dates).distinct(), "dim-date")
    return rows + lake.write("silver.dim_date", dates, "overwrite", LOOKUP_BATCH)


def silver_gate(lake: Lake, sources: list[SourceConfig], day: str) -> DataFrame:
    """The checks of the day's star, and that no column that a source names as personal is left in silver."""
    star, personal = stored_star(lake, day), {cfg.source_id: cfg.pii for cfg in sources if cfg.pii}
    checks = quality.silver_checks(star)
    if personal:
        tables = {n: getattr(star, n) for n in (*DIMS, *FACTS)}
        checks = checks.unionByName(quality.personal_checks(tables, personal))
    return checks


def newer_day(lake: Lake, day: str) -> bool:
    """Whether a later day than this is stored already."""
    return lake.exists("silver.dim_date") and not lake.scan("silver.dim_date").where(F.col("date_sk") > _sk(day)).isEmpty()


def stored_star(lake: Lake, day: str | None = None) -> s.Star:
    """The silver tables; with a day, the facts of that day only, by folder."""

    def fact(name: str) -> DataFrame:
        df = lake.scan(f"silver.{name}")
        return df.where(F.col("date_sk") == _sk(day)) if day else df

    dims = {n: lake.scan(f"silver.{n}") for n in DIMS}
    small = s.below_broadcast(dims["dim_account"], dims["dim_customer"])
    return s.Star(**dims, **{n: fact(n) for n in FACTS}, lookup_first=small)


def write_gold(lake: Lake, day: str) -> int:
    """KPI row and marts of one day, each replacing that day's batch. The day gets its KPI row whatever the facts hold."""
    star, prior = stored_star(lake, day), None
    if lake.exists("gold.kpi_daily"):
        prior = k.latest_row(lake.scan("gold.kpi_daily").where(F.col("date") < day))
    days = lake.spark.range(1, numPartitions=1).select(F.lit(_sk(day)).alias("date_sk"))
    rows = lake.write("gold.kpi_daily", k.kpi_daily(star, prior, days).where(F.col("date") == day), "append", day)
    lake.write("gold.deposits_by_segment", k.deposits_by_segment(star), "append", day)
    lake.write("gold.txn_by_channel", k.txn_by_channel(star), "append", day)
    lake.write("gold.loans_by_status", k.loans_by_status(star.fact_loan), "append", day)
    lake.write(ACTIVE_BITS, active_bits(star), "append", day)
    return rows


def active_bits(star: s.Star) -> DataFrame:
    """(date, segment, country, channel, bucket, bits): who was active, so that any days and cells count exactly later."""
    facts = star.fact_transaction.select("date_sk", star.account_key, star.channel_key).distinct()
    rows = facts.join(star.owners("customer_sk", "segment", "country"), star.account_key, "left")
    rows = s.txn_channel(rows, star.dim_channel, star.channel_key).withColumn("date", c.iso(c.sk_to_date(F.col("date_sk"))))
    return measures.customer_bits(rows, ["date", "segment", "country", "channel"])


def gold_gate(lake: Lake) -> DataFrame:
    """(stage, outcome, details) of the KPIs of the newest day against their bounds."""
    checks = quality.gold_checks(k.latest_row(lake.scan("gold.kpi_daily")))
    word = F.when(F.col("outcome") == "fail", "OUT OF").otherwise("in")
    text = F.format_string("%s=%s %s [%.0f,%.0f]", "kpi", F.col("value").cast("string"), word, "low", "high")
    return checks.select(F.lit("gold").alias("stage"), "outcome", text.alias("details"))


def run_day(
    spark: SparkSession,
    lake: Lake,
    sources: list[SourceConfig],
    lookups: dict[str, DataFrame],
    day: str,
    contracts: dict = fixed.CONTRACTS,
    salt: str | None = None,
    manifests: str | None = None,
    retry: bool = False,
    trigger: str = "schedule",
    rates: DataFrame | None = None,
) -> Run:
    """Land, check, conform, check, aggregate, check one day. What follows a gate is the decision of
    :func:`tidemark.operators.quality.gate_decision`: a failed bronze or silver gate stops the run; with ``retry`` the
    stage is done once more first, and a second failure escalates; gold never blocks. ``rates`` are daily rates."""
    salt = salt or c.pii_salt(spark)
    run = Run(f"{day}T00:00Z-{trigger}-{uuid.uuid4().hex[:6]}", day, [cfg.source_id for cfg in sources], trigger)

    txn_batch = next((f"{cfg.source_id}:{day}" for cfg in sources if cfg.target == "bronze.transactions"), "")

    broken: dict[str, dict[str, int]] = {}

    def extract() -> int:
        landed = land(lake, sources, lookups, run.run_id, day, contracts=contracts)
        for cfg in sources:
            stats.keep_counts(lake, cfg.source_id, day, landed.by_source[cfg.source_id])
        broken.update(landed.broken)
        return sum(landed.rows.values())

    def guarded(layer: str, stage: str, actor: str, work, gate) -> bool:
        attempt, action = 0, "retry"
        while action == "retry":
            run.step(stage, actor, work)
            asked = [(layer, run.check(gate(), attempt), attempt, "retry" if retry else None)]
            frame = spark.createDataFrame(asked, "layer string, outcome string, retries int, requested string")
            action, attempt = quality.gate_decision(frame).first().action, attempt + 1
        if action == "proceed":
            return True
        run.audit.append(("gate", f"decide:{stage}", None, None, action, "", _now()))
        run.stages[stage], run.status = "failed", "failed"
        return False

    try:
        if (
            guarded("bronze", "extract", "extraction", extract, lambda: bronze_gate(lake, sources, contracts, day, broken))
            and guarded(
                "silver", "transform", "transformation", lambda: write_silver(lake, run, salt, txn_batch, rates),
                lambda: silver_gate(lake, sources, day),
            )
            and guarded("gold", "aggregate", "aggregation", lambda: write_gold(lake, day), lambda: gold_gate(lake))
        ):
            run.status = "success"
    finally:
        if manifests:
            run.save(spark, manifests)
    return run


# manifests as tables -------------------------------------------------------------------------------------


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True)
    return reader.json(path)


def manifest_qa(manifests: DataFrame) -> DataFrame:
    return manifests.select("run_id", F.inline("qa"))


def manifest_audit(manifests: DataFrame) -> DataFrame:
    return manifests.select("run_id", F.inline("audit"))


def audit_by_actor(manifests: DataFrame) -> DataFrame:
    return (
        manifest_audit(manifests).groupBy("actor")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.sum("rows").alias("rows"),
            F.round(F.sum("duration_s"), 3).alias("duration_s"),
            F.count_if(F.col("outcome") == "error").alias("errors"),
        )
    )


def manifest_stages(manifests: DataFrame, stages: tuple[str, ...] = ("extract", "transform", "aggregate")) -> DataFrame:
    """One row per run with a column per stage."""
    return manifests.select("run_id", "status", *[F.col("stages").getItem(x).alias(x) for x in stages])


def daily_manifests(transactions: DataFrame, contract: dict) -> DataFrame:
    """Run records for every day of a transaction table, from one scan per kind of check.

    What is collected into a record is one entry per check and per stage.
    """
    dated = transactions.withColumn("day", F.date_format("posting_ts", "yyyy-MM-dd"))
    broken = quality.count_broken(dated, contract, ["day"])
    for column in contract.get("unique", []):
        broken = broken.unionByName(quality.count_repeats(dated, column, ["day"]))
    at = F.concat("day", F.lit("T00:00:00Z"))
    entry = F.struct(
        F.concat(F.lit("bronze:"), F.col("check")).alias("stage"),
        F.when(F.col("n") > 0, "fail").otherwise("pass").alias("outcome"),
        F.concat(F.col("n").cast("string"), F.lit(" row(s)")).alias("details"),
        at.alias("checked_at"),
    )
    qa = broken.groupBy("day").agg(F.array_sort(F.collect_list(entry)).alias("qa"), F.sum("n").alias("bad"))
    volume = dated.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"),
        (F.unix_timestamp(F.max("posting_ts")) - F.unix_timestamp(F.min("posting_ts"))).cast("double").alias("span"),
    )
    ok = F.col("bad") == 0
    done = F.when(ok, "passed").otherwise("pending")

    def audit(actor: str, action: str, rows, outcome):
        return F.struct(
            F.lit(actor).alias("actor"), F.lit(action).alias("action"), rows.cast("bigint").alias("rows"),
            F.col("span").alias("duration_s"), outcome.alias("outcome"), F.lit("").alias("note"), at.alias("at"),
        )

    return qa.join(volume, "day").select(
        F.concat(F.lit("run-"), F.col("day")).alias("run_id"),
        F.lit("backfill").alias("trigger"),
        F.col("day").alias("window_from"),
        F.col("day").alias("window_to"),
        F.array(F.lit("core_transactions")).alias("sources"),
        F.create_map(
            F.lit("extract"), F.when(ok, "passed").otherwise("failed"), F.lit("transform"), done,
            F.lit("aggregate"), done,
        ).alias("stages"),
        "qa",
        F.array(
            audit("extraction", "extract", F.col("n"), F.lit("ok")),
            audit("validation", "gate", F.col("bad"), F.when(ok, "ok").otherwise("error")),
        ).alias("audit"),
        F.when(ok, "success").otherwise("failed").alias("status"),
    )
