"""Surrogate keys that never move: an append-only registry of the entities met so far.

A registry is a table of its own (natural key, surrogate key), never the dimension that a run writes anew. A run looks its
entities up, null-safe, and gives keys after the greatest to those it meets for the first time. An allocation is one
batch, named by its first key, and is committed before any table uses it: keys that were given out stay given out, whoever
leaves, comes back or is added later, and a run that failed behind its allocation finds it again. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.slices import dense_key
from tidemark.sources.lake import Lake

#: Adds the key column ``name`` for the natural key to a frame: (frame, natural, name).
Keys = Callable[[DataFrame, str, str], DataFrame]


@dataclass(frozen=True)
class Registry:
    lake: Lake
    table: str
    natural: str
    name: str

    def known(self) -> DataFrame | None:
        """(natural, key) of every entity that ever got one; None before the first."""
        return self.lake.scan(self.table).select(self.natural, self.name) if self.lake.exists(self.table) else None

    def allocate(self, df: DataFrame) -> int:
        """Give keys to the entities of ``df`` that have none, in the order of the natural key; returns how many."""
        seen, known, top = df.select(self.natural).distinct(), self.known(), 0
        if known is not None:
            top = known.agg(F.max(self.name)).first()[0] or 0
            held = known.select(F.col(self.natural).alias("_held"))
            seen = seen.join(held, seen[self.natural].eqNullSafe(held["_held"]), "left_anti")
        fresh = dense_key(seen, [self.natural], self.name).select(
            self.natural, (F.col(self.name) + F.lit(top)).cast("bigint").alias(self.name)
        )
        if fresh.isEmpty() and known is not None:
            return 0
        return self.lake.write(self.table, fresh, "append", f"{top + 1:020d}")

    def lookup(self, df: DataFrame) -> DataFrame:
        """``df`` with the key in front; a null natural key is an entity like others, one without a key gets null."""
        known = self.known().toDF("_natural", self.name)
        joined = df.join(known, df[self.natural].eqNullSafe(known["_natural"]), "left")
        return joined.select(self.name, *[df[x] for x in df.columns])

    def assign(self, df: DataFrame) -> DataFrame:
        self.allocate(df)
        return self.lookup(df)


def registered(lake: Lake, layer: str = "keys") -> Keys:
    """Keys of a lake's registries, one table per key column."""

    def keys(df: DataFrame, natural: str, name: str) -> DataFrame:
        return Registry(lake, f"{layer}.{name}", natural, name).assign(df)

    return keys


def dense(df: DataFrame, natural: str, name: str) -> DataFrame:
    """Keys 1..n by natural key, for a table that is built once."""
    return dense_key(df, [natural], name)
