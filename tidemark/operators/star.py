"""Silver star schema: dimensions, facts and their joins."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import fx
from tidemark.operators.history import dedup_latest
from tidemark.operators.keys import Keys, dense
from tidemark.session import materialise


@dataclass(frozen=True)
class Star:
    """Dimensions and facts. ``account_key`` and ``channel_key`` name the columns by which the facts reach
    their dimensions: surrogate keys in stored silver, natural keys in facts not joined yet. A dimension has
    both, so a plan over unjoined facts can aggregate first and look up a key once per group.

    ``lookup_first`` says that the account and customer dimensions, unpacked, are below the session's broadcast threshold:
    then facts take their attributes as they are scanned, and only a few rows per result group are shuffled. It picks the
    plan only.
    """

    dim_customer: DataFrame
    dim_account: DataFrame
    dim_channel: DataFrame
    dim_product: DataFrame
    fact_transaction: DataFrame
    fact_account_balance: DataFrame
    fact_loan: DataFrame
    account_key: str = "account_sk"
    channel_key: str = "channel_sk"
    lookup_first: bool = False

    def owners(self, *columns: str) -> DataFrame:
        """Attributes of accounts and their customers by ``account_key``, as the built side of a join."""
        key = self.account_key
        mine = [x for x in columns if x in self.dim_account.columns and x != key]
        other = [x for x in columns if x not in self.dim_account.columns]
        out = self.dim_account.select(key, *dict.fromkeys([*mine, *(["customer_sk"] if other else [])]))
        if other:
            out = out.join(self._built(self.dim_customer.select("customer_sk", *other)), "customer_sk", "left")
        return self._built(out.select(key, *columns))

    def _built(self, dim: DataFrame) -> DataFrame:
        """The dimension as the side that a join builds; left to estimates, Spark may collect and broadcast the facts.

        A large one is hashed partition by partition, so that the facts are not sorted and a hot key can still be split.
        """
        return dim.hint("broadcast" if self.lookup_first else "shuffle_hash")

    @property
    def dim_date(self) -> DataFrame:
        return dim_date([self.fact_transaction, self.fact_account_balance, self.fact_loan])


def below_broadcast(*dims: DataFrame) -> bool:
    """Whether each stored dimension, unpacked, has fewer bytes than Spark broadcasts by itself; a threshold of -1 is
    never met.

    Spark measures the files of a stored table. Those are packed many times smaller than the rows that the driver would
    hold, so the rows are counted, which reads file footers only, and taken at the widths of their types.
    """
    limit = dims[0].sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return limit > 0 and all(dim.count() * (dim._jdf.schema().defaultSize() + ROW_BYTES) <= limit for dim in dims)


#: What a row takes in memory beside its values.
ROW_BYTES = 8


def _measured(dim: DataFrame) -> DataFrame:
    """A stored dimension for a join by its unpacked size: a large one is merge-joined, never sent through the driver."""
    return dim if below_broadcast(dim) else dim.hint("merge")


def by_keys(
    star: Star, facts: DataFrame, keys: list[str], parts: dict[str, Column], sparse: bool = False
) -> DataFrame:
    """Additive parts of facts by the keys of their dimensions, ready for a lookup and a further sum.

    Beside a large dimension postings are combined first, map-side, so a hot key is one row per group when it is shuffled
    for the lookup. ``sparse`` facts (balances, loans: few rows per key and day) are not: that would shuffle and hold
    nearly every row once more.
    """
    if star.lookup_first or sparse:
        return facts.select(*keys, *[part.alias(name) for name, part in parts.items()])
    return facts.groupBy(*keys).agg(*[F.sum(part).alias(name) for name, part in parts.items()])


def drop_pii(df: DataFrame, pii: list[str], tokens: list[str], salt: str) -> DataFrame:
    """Replace personal columns: those in ``tokens`` become ``<name>_token``, the others are left out."""
    kept = [F.col(x) for x in df.columns if x not in pii]
    return df.select(*kept, *[c.token(F.col(x), salt).alias(f"{x}_token") for x in pii if x in tokens])


def _stamp(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumns(
        {
            "valid_from": F.lit(as_of).cast("date"),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def dim_customer(customers: DataFrame, salt: str, as_of: str, keys: Keys = dense) -> DataFrame:
    """One row per customer, the newest if a source repeats one; the name only as a token."""
    safe = dedup_latest(
        customers.select(
            "customer_id", c.token(F.col("full_name"), salt).alias("customer_token"), "segment", "country",
            "onboarded_date",
        ),
        ["customer_id"], ["onboarded_date"],
    ).drop("onboarded_date")
    return _stamp(keys(safe, "customer_id", "customer_sk"), as_of)


def dim_account_customer(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts with the surrogate key of their customer."""
    return accounts.join(_measured(customers.select("customer_id", "customer_sk")), "customer_id", "left")


def dim_account(accounts: DataFrame, customers: DataFrame, as_of: str, keys: Keys = dense) -> DataFrame:
    """One row per account, the newest snapshot if a source repeats one, so that no fact is multiplied."""
    base = dedup_latest(
        accounts.select("account_id", "customer_id", "product_type", "status", "snapshot_date"),
        ["account_id"], ["snapshot_date"],
    ).drop("snapshot_date")
    return _stamp(dim_account_customer(keys(base, "account_id", "account_sk"), customers), as_of)


def lookup_dim(df: DataFrame, natural: str, key: str, keys: Keys | None = None) -> DataFrame:
    """Key of a lookup table, which is a handful of rows by definition; from a registry where one is kept."""
    if keys:
        return keys(df, natural, key)
    return df.select(F.row_number().over(Window.orderBy(natural)).alias(key), *df.columns)


def txn_values(txns: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """EUR amount, flags and date key of each posting; natural keys are still there, personal columns not."""
    kind = F.col("txn_type")
    txns = fx.with_rate(txns, "currency", "posting_ts", rates)
    return txns.select(
        "txn_id",
        "account_id",
        "channel",
        c.money(F.col("amount") * F.col(fx.RATE)).alias("amount_eur"),
        "txn_type",
        c.is_fee(kind).alias("is_fee"),
        c.is_interest(kind).alias("is_interest"),
        c.date_sk(F.col("posting_ts")).alias("date_sk"),
    )


def balance_values(snapshots: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    product = F.col("product_type")
    snapshots = fx.with_rate(snapshots, "currency", "snapshot_date", rates)
    return snapshots.select(
        "account_id",
        c.money(F.col("balance") * F.col(fx.RATE)).alias("balance_eur"),
        c.is_deposit(product).alias("is_deposit"),
        c.is_loan(product).alias("is_loan"),
        c.date_sk(F.col("snapshot_date")).alias("date_sk"),
    )


def loan_values(snapshots: DataFrame) -> DataFrame:
    """Loans are in EUR already."""
    return snapshots.select(
        "loan_id",
        "account_id",
        c.money(F.col("principal_outstanding")).alias("principal_outstanding_eur"),
        "interest_rate",
        "days_past_due",
        c.is_npl(F.col("days_past_due")).alias("is_npl"),
        c.date_sk(F.col("snapshot_date")).alias("date_sk"),
    )


def fact_account_keys(values: DataFrame, accounts: DataFrame) -> DataFrame:
    """The account's surrogate key for its natural key. A small dimension is broadcast by its unpacked size, a large one
    is merge-joined and a hot account is split by the skew join."""
    return values.join(_measured(accounts.select("account_id", "account_sk")), "account_id", "left").drop("account_id")


def fact_txn_keys(values: DataFrame, accounts: DataFrame, channels: DataFrame) -> DataFrame:
    return (
        fact_account_keys(values, accounts)
        .join(channels.select("channel", "channel_sk"), "channel", "left")
        .drop("channel")
    )


def keyed(star: Star) -> Star:
    """The star with surrogate keys in its facts, as it is stored."""
    return replace(
        star,
        fact_transaction=fact_txn_keys(star.fact_transaction, star.dim_account, star.dim_channel),
        fact_account_balance=fact_account_keys(star.fact_account_balance, star.dim_account),
        fact_loan=fact_account_keys(star.fact_loan, star.dim_account),
        account_key="account_sk",
        channel_key="channel_sk",
    )


def dim_date(facts: list[DataFrame]) -> DataFrame:
    """One row per day that occurs in a fact."""
    days = facts[0].select("date_sk")
    for fact in facts[1:]:
        days = days.union(fact.select("date_sk"))
    day = c.sk_to_date(F.col("date_sk"))
    return days.distinct().select(
        "date_sk",
        day.alias("date"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


def build(
    customers: DataFrame,
    accounts: DataFrame,
    account_snapshots: DataFrame,
    loan_snapshots: DataFrame,
    transactions: DataFrame,
    channels: DataFrame,
    products: DataFrame,
    salt: str,
    as_of: str,
    keys: Keys | None = None,
    rates: DataFrame | None = None,
) -> Star:
    """The star of the given sources: dimensions stored, facts lazy and by natural key.

    ``keys`` gives the surrogate keys, as :func:`tidemark.operators.keys.registered` does from what it gave out before;
    without it they count from 1. ``rates`` are daily rates (currency, date, rate); without them the fixed ones hold.
    """
    customer_dim = dim_customer(customers, salt, as_of, keys or dense)
    if keys:
        customer_dim = materialise(customer_dim, "dim-customer")
    account_dim = materialise(dim_account(accounts, customer_dim, as_of, keys or dense), "dim-account")
    return Star(
        dim_customer=customer_dim,
        dim_account=account_dim,
        dim_channel=lookup_dim(channels, "channel", "channel_sk", keys),
        dim_product=lookup_dim(products, "product_type", "product_sk", keys),
        fact_transaction=txn_values(transactions, rates),
        fact_account_balance=balance_values(account_snapshots, rates),
        fact_loan=loan_values(loan_snapshots),
        account_key="account_id",
        channel_key="channel",
        lookup_first=below_broadcast(account_dim, customer_dim),
    )


# joins over the star -------------------------------------------------------------------------------------


def txn_customer(star: Star, rows: DataFrame) -> DataFrame:
    return rows.join(star.owners("customer_sk"), star.account_key, "left")


def txn_channel(txns: DataFrame, channels: DataFrame, key: str = "channel_sk") -> DataFrame:
    return txns.join(channels.select(*dict.fromkeys([key, "channel", "is_digital"])), key, "left")


def balance_segment(star: Star, rows: DataFrame) -> DataFrame:
    """Two hops: balance to account to customer."""
    return rows.join(star.owners("customer_sk", "segment"), star.account_key, "left")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct child keys without a parent. Duplicates go before the join on both sides, so a hot key is one
    row."""
    parents = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.select(key).distinct().join(parents, key, "left_anti")


def unresolved_fk(facts: DataFrame, key: str) -> DataFrame:
    return facts.agg(F.count_if(F.col(key).isNull()).alias("unresolved"), F.count(F.lit(1)).alias("rows"))
