"""Near-duplicate vectors by NN-descent over a neighbour graph kept in tables.

Equal vectors are one class, and classes within half the link angle of a leader are one bundle, in which all link by the
triangle inequality, so neither is ever paired out. The graph over bundles starts from neighbours in a few random orders,
sorted by range: a node's place in an order is the cell that random planes put it in, then its place along a direction.
A round joins neighbours of neighbours (through a common node, both directions), scores new pairs by exact cosine and keeps
the best few of each node and all pairs of bundles that may hold links. A node whose list is saturated with those gets a
longer list. Rounds go on until list entries stop changing, and the recall of a stated query set against all classes is
audited by blocked products; a failing audit of the links between bundles doubles the orders and continues. Where the query
set has no link at all, nothing is measured: then the orders double until that finds no further pair. After PHASES doublings all bundles are
compared by blocks instead. What the audit itself finds is not kept. Members of two bundles are compared by blocks, which
give counts per member and never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, cos, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, map_rows
from tidemark.operators.slices import dense_key
from tidemark.session import materialise, scratch

#: Parameters: link threshold, list length, orders to start from, neighbours in each, nodes of a cell of an order, share
#: of new list entries that ends the rounds, doublings of the orders before all bundles are compared.
THRESHOLD, LIST, PROJECTIONS, REACH, CELL, CHANGED, PHASES = 0.9, 10, 8, 6, 24, 0.02, 4
#: The query set of the audit, its least recall, bytes of vectors in a broadcast, sides of a product.
AUDIT_EVERY, RECALL, ASKED_BYTES, PRODUCT_ROWS = 100, 0.9, 8 << 20, 1024
#: Rows of a range of an order, rounds of bundling, members of a block, and what rounding may do to an angle.
RANGE_ROWS, MIN_RANGES, BUNDLE_ROUNDS, BLOCK, SLACK = 50_000, 8, 10, 128, 1e-6


def _lists_of(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sizes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)


def _clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): unit vectors in double precision; null where a vector can link with nothing."""

    def work(batch: pa.RecordBatch):
        sizes = _sizes(batch.column(1))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            ids, fine = batch.column(0).take(pa.array(rows)), np.zeros(len(rows), bool)
            if size:
                x = _matrix(batch.column(1).take(pa.array(rows)), size)
                top = np.abs(x).max(axis=1)  # a null component is read as not a number
                fine = np.isfinite(top) & (top > 0)
                x = x[fine] / top[fine, None]
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                x += 0.0  # one zero only
                yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fine)), _lists_of(x)], names=["vec_id", "v"])
            rest = ids.filter(pa.array(~fine))
            yield pa.RecordBatch.from_arrays([rest, pa.nulls(len(rest), pa.list_(pa.float64()))], names=["vec_id", "v"])

    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return map_rows(plain, work, "vec_id long, v array<double>")


def _projected(nodes: DataFrame, seed: int, n: int, total: int) -> DataFrame:
    """(node, p, x): the place of every node in ``n`` random orders.

    The whole part of x is the cell that random planes through zero put the node in, of about CELL nodes if those lie
    evenly; the rest grows along a further direction. Near vectors share a cell more often than a place along one line.
    """
    planes = min(40, max(0, round(log2(max(total, 1) / CELL))))

    def work(batch: pa.RecordBatch):
        sizes = _sizes(batch.column(1))
        for size in np.unique(sizes).tolist():
            some = np.flatnonzero(sizes == size)
            axes = np.random.default_rng((seed, size)).normal(size=(planes + 1, size, n))
            v = _matrix(batch.column(1).take(pa.array(some)), size)
            x = 0.5 + np.arctan(v @ axes[0]) / np.pi
            for k in range(planes):
                x += np.ldexp((v @ axes[k + 1]) > 0, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(some, n))), pa.array(np.tile(np.arange(n), len(some))), pa.array(x.ravel())],
                names=["node", "p", "x"],
            )

    return map_rows(nodes.select("node", "v"), work, "node long, p long, x double")


def _along(nodes: DataFrame, seed: int, n: int, reach: int, total: int) -> DataFrame:
    """(a, b), a < b: nodes near each other in an order. Ranges of places are dealt out, so equal places split too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.zeros((2, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([tail, [batch.column(i).to_numpy() for i in (0, 1)]], axis=1)
            for k in range(1, reach + 1):
                later = np.arange(max(k, tail.shape[1]), rows.shape[1])
                later = later[rows[1, later] == rows[1, later - k]]
                ends = np.sort(np.stack([rows[0, later], rows[0, later - k]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], names=["a", "b"])
            tail = rows[:, -reach:]

    ranges = max(MIN_RANGES, total * n // RANGE_ROWS)
    placed = _projected(nodes, seed, n, total).repartitionByRange(ranges, "p", "x", "node").sortWithinPartitions("p", "x", "node")
    return placed.select("node", "p").mapInArrow(run, "a long, b long").where("a < b").distinct()


def _scored(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, cosine, near) by exact products of unit vectors; near: within the link angle, widened by both radii.

    Vectors of different length do not compare.
    """
    left = nodes.select(F.col("node").alias("a"), F.col("v").alias("va"), F.col("radius").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("v").alias("vb"), F.col("radius").alias("rb"))
    joined = pairs.join(left, "a").join(right, "b").where(F.size("va") == F.size("vb"))
    angle = acos(threshold)

    def work(batch: pa.RecordBatch):
        va, vb = batch.column(2), batch.column(3)
        cosine, sizes = np.empty(batch.num_rows), _sizes(va)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            cosine[rows] = np.einsum("ij,ij->i", *(_matrix(c.take(pa.array(rows)), size) for c in (va, vb)))
        wide = batch.column(4).to_numpy()
        widened = np.arccos(np.clip(cosine, -1, 1)) <= angle + wide + SLACK
        near = np.where(wide > 0, widened, cosine >= threshold)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(cosine), pa.array(near)], names=["a", "b", "cosine", "near"]
        )

    return map_rows(
        joined.select("a", "b", "va", "vb", (F.col("ra") + F.col("rb")).alias("wide")), work,
        "a long, b long, cosine double, near boolean",
    )


def _both(edges: DataFrame, *columns: str) -> DataFrame:
    return edges.select("a", "b", *columns).unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), *columns))


def bundles(classes: DataFrame, total: int, threshold: float = THRESHOLD) -> DataFrame:
    """(node, leader, cosine): classes within half the link angle of their leader; a class alone leads itself.

    In a round leaders meet along projections, and those without a smaller close neighbour take the close ones over. The
    members of a leader that was taken over follow if they are close to the new one too, and else lead themselves.
    Rounds end when fewer than one leader in a thousand was taken over.
    """
    tight = cos(acos(threshold) / 2 - SLACK)
    vectors = classes.select("node", "v", F.lit(0.0).alias("radius"))
    members = classes.select("node", F.col("node").alias("leader"), F.lit(1.0).alias("cosine"))
    leaders, n = vectors, total
    for turn in range(BUNDLE_ROUNDS):
        met = _scored(_along(leaders, 1000 + turn, PROJECTIONS, REACH, n), leaders, tight)
        close = materialise(met.where("near").select("a", "b"), "nn-close")
        heads = close.select("a").distinct().join(close.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        taken = close.join(heads, "a").groupBy(F.col("b").alias("leader")).agg(F.min("a").alias("head"))
        taken = materialise(taken, "nn-taken")
        moved = taken.count()
        if not moved:
            break
        following = members.join(taken, "leader").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"), "node", "head")
        rated = _scored(following.select("a", "b"), vectors, tight)
        follow = following.join(rated, ["a", "b"]).select(
            "node",
            F.when(F.col("near"), F.col("head")).otherwise(F.col("node")).alias("leader"),
            F.when(F.col("near"), F.col("cosine")).otherwise(F.lit(1.0)).alias("cosine"),
        )
        members = materialise(members.join(taken, "leader", "left_anti").select("node", "leader", "cosine").unionByName(follow), "nn-members")
        leaders = vectors.join(members.where("node = leader").select("node"), "node", "left_semi")
        n -= moved
        if moved * 1000 < n:
            break
    return members


def _lists(edges: DataFrame, length: int, most: int) -> DataFrame:
    """(node, other): the best of each node; up to ``most`` where the list is full of near ones."""
    both = _both(edges, "cosine", "near")
    ranked = both.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b")))
    ranked = ranked.where(F.col("r") <= max(length, most))  # Spark cuts a hub's rows by this before they are shuffled
    full = (F.col("r") <= most) & F.col("near")
    return ranked.where((F.col("r") <= length) | full).select(F.col("a").alias("node"), F.col("b").alias("other"))


def _blocked(asked: DataFrame, rows: DataFrame, threshold: float, label: str, once: bool = False) -> DataFrame:
    """(a, b, cosine), a < b: keys of ``asked`` and ``rows`` (key, v, radius) whose vectors are near, by exact products.

    ``once`` is for rows asked about themselves: each pair is met from its greater key only.

    The asked are dealt by hash of the vector into blocks of about ASKED_BYTES, each a broadcast that all rows are
    multiplied with, a few of either at a time.
    """
    spark, path, angle = rows.sparkSession, scratch(rows.sparkSession, label), acos(threshold)
    asked = asked.select("key", "v", "radius")
    size_of = asked.agg(F.sum(F.size("v")).cast("long")).first()[0] or 0
    blocks = max(1, -(-8 * size_of // ASKED_BYTES))
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("v", F.lit(11)), F.lit(blocks)) == block).toArrow().combine_chunks()
        by_size = {}
        for size in pc.unique(pc.list_value_length(held["v"])).to_pylist():
            some = held.filter(pc.equal(pc.list_value_length(held["v"]), size)).combine_chunks()
            keys, vectors, radii = (some[c].combine_chunks() for c in ("key", "v", "radius"))
            by_size[size] = (keys.to_numpy(zero_copy_only=False), _matrix(vectors, size), radii.to_numpy(zero_copy_only=False))
        shared = spark.sparkContext.broadcast(by_size)

        def work(batch: pa.RecordBatch, shared=shared):
            keys, sizes, radii = batch.column(0).to_numpy(), _sizes(batch.column(1)), batch.column(2).to_numpy()
            for size in np.unique(sizes).tolist():
                if size not in shared.value:
                    continue
                of_size, (ask, vectors, ask_radii) = np.flatnonzero(sizes == size), shared.value[size]
                for at in range(0, len(of_size), PRODUCT_ROWS):
                    some = of_size[at : at + PRODUCT_ROWS]
                    v = _matrix(batch.column(1).take(pa.array(some)), size)
                    for first in range(0, len(ask), PRODUCT_ROWS):
                        to = slice(first, first + PRODUCT_ROWS)
                        widest = angle + radii[some].max() + ask_radii[to].max() + SLACK
                        product = v @ vectors[to].T
                        i, j = np.nonzero(product >= min(threshold, cos(min(widest, np.pi)) - SLACK))
                        cosine, j = product[i, j], j + first
                        wide, one, two = radii[some[i]] + ask_radii[j], keys[some[i]], ask[j]
                        widened = np.arccos(np.clip(cosine, -1, 1)) <= angle + wide + SLACK
                        fine = np.where(wide > 0, widened, cosine >= threshold) & (one < two if once else one != two)
                        ends = np.sort(np.stack([one[fine], two[fine]]), axis=0)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ends[0]), pa.array(ends[1]), pa.array(cosine[fine])], names=["a", "b", "cosine"]
                        )

        found = map_rows(rows.select("key", "v", "radius"), work, "a long, b long, cosine double")
        found.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema("a long, b long, cosine double").parquet(path)


def _audit(rows: DataFrame, classes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): links of the query set with other classes, counted by pair of bundles; a = b within a bundle.

    The query set are all rows whose id is divisible by AUDIT_EVERY, equal ones once; they are compared with all classes.
    """
    placed = classes.join(members, "node").select("node", F.col("leader").alias("key"), "v", F.lit(0.0).alias("radius"))
    asked = rows.where(F.col("vec_id") % AUDIT_EVERY == 0).select("node").distinct()
    asked = materialise(placed.join(asked, "node", "left_semi"), "nn-asked")
    across = _blocked(asked, placed, threshold, "nn-answers").groupBy("a", "b").agg(F.count("*").alias("n"))
    sizes = members.groupBy("leader").agg((F.count("*") - 1).alias("n")).where("n > 0")
    inside = asked.join(sizes, F.col("key") == F.col("leader")).groupBy("leader").agg(F.sum("n").alias("n"))
    return across.unionByName(inside.select(F.col("leader").alias("a"), F.col("leader").alias("b"), "n"))


def near_bundles(
    rows: DataFrame, classes: DataFrame, members: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, length: int = LIST
) -> tuple[DataFrame, float | None]:
    """Pairs of bundles (a, b, cosine) that may hold links, and their audited recall, which is at least RECALL.

    It counts links of the query set between different vectors, those in a bundle included, and has to reach RECALL between
    bundles alone too. It is None where the query set has no link, so that nothing could be measured. Only pairs that share a list with an entry of the last round meet in a round.
    """
    total = nodes.count()
    truth = materialise(_audit(rows, classes, members, threshold), "nn-audit")
    across = F.col("a") != F.col("b")
    wanted, inside = (x or 0 for x in truth.agg(F.sum(F.when(across, F.col("n"))), F.sum(F.when(~across, F.col("n")))).first())
    edges = nodes.sparkSession.createDataFrame([], "a long, b long, cosine double, near boolean")
    lists = nodes.sparkSession.createDataFrame([], "node long, other long")
    phase, turn, before_that = 0, 0, -1
    while True:
        projections = PROJECTIONS << phase
        whole = phase > PHASES
        if whole:
            every = nodes.withColumnRenamed("node", "key")
            near = _blocked(every, every, threshold, "nn-all", once=True)
        else:
            more = _along(nodes, phase, projections, REACH, total).join(edges, ["a", "b"], "left_anti")
            edges = materialise(edges.unionByName(_scored(more, nodes, threshold)), "nn-edges")
            while True:
                turn += 1
                before = lists.select("node", "other", F.lit(True).alias("old"))
                lists = _lists(edges, length, length << min(turn, 30)).join(before, ["node", "other"], "left")
                lists = materialise(lists.select("node", "other", F.col("old").isNull().alias("new")), "nn-lists")
                entries, new = lists.agg(F.count("*"), F.count_if("new")).first()
                if new <= CHANGED * entries:
                    break
                step = lists.select(F.col("other").alias("via"), F.col("node").alias("x"), F.col("new").alias("new_x"))
                onward = lists.select(F.col("node").alias("via_y"), F.col("other").alias("y"), F.col("new").alias("new_y"))
                meet = (F.col("via") == F.col("via_y")) & (F.col("x") != F.col("y")) & (F.col("new_x") | F.col("new_y"))
                met = step.join(onward, meet).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                fresh = met.distinct().join(edges, ["a", "b"], "left_anti")
                kept = lists.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
                listed = edges.where("NOT near").join(kept, ["a", "b"], "left_semi")
                old = edges.where("near").unionByName(listed)
                edges = materialise(old.unionByName(_scored(fresh, nodes, threshold)), "nn-edges")
            near = edges.where("near").select("a", "b", "cosine")
        if wanted:
            found = truth.join(near, ["a", "b"], "left_semi").agg(F.sum("n")).first()[0] or 0
            if found >= RECALL * wanted:
                return near, (inside + found) / (inside + wanted)
            if whole:
                raise RuntimeError(f"recall {found / wanted} of an exact comparison")
        elif inside:
            return near, 1.0
        else:
            held = near.count()
            if whole or held == before_that:
                return near, None
            before_that = held
        phase += 1


def _member_links(mixed: DataFrame, members: DataFrame, classes: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, node, more): rows of the other bundle that a member links with, for pairs where only some do; by blocks."""
    wanted = mixed.select(F.explode(F.array("a", "b")).alias("leader")).distinct()
    dealt = members.join(wanted, "leader").join(nodes.select(F.col("node").alias("leader"), "n"), "leader")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col("n") / BLOCK)))
    blocks = dealt.join(classes, "node").groupBy("leader", "block").agg(F.collect_list(F.struct("node", "size", "v")).alias("rows"))
    blocks = materialise(blocks.select("leader", "rows"), "nn-blocks")
    left = blocks.select(F.col("leader").alias("a"), F.col("rows").alias("ra"))
    right = blocks.select(F.col("leader").alias("b"), F.col("rows").alias("rb"))

    def work(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            sides = []
            for side in (2, 3):
                rows = batch.column(side)[i].values
                v = rows.field("v")
                sides.append((rows.field("node").to_numpy(), rows.field("size").to_numpy(), _matrix(v, len(v[0]))))
            (na, sa, va), (nb, sb, vb) = sides
            linked = va @ vb.T >= threshold
            more = np.r_[linked @ sb, sa @ linked]
            hit = np.flatnonzero(more)
            ends = [pa.array(np.full(len(hit), batch.column(k)[i].as_py(), np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*ends, pa.array(np.r_[na, nb][hit]), pa.array(more[hit])], names=["a", "b", "node", "more"]
            )

    pairs = mixed.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ra", "rb")
    return map_rows(pairs, work, "a long, b long, node long, more long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, class_id, recall) of every row.

    ``recall`` is the audited one, null where the query set has no link.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows with equal
    vectors link with each other, also when they repeat an id; a null id takes part but
    names no component.
    Further columns are left out. An empty table gives none.
    """
    clean = materialise(_clean(vectors).withColumn("h", F.xxhash64("v")), "nn-vectors")
    live = clean.where("v IS NOT NULL")
    classes = live.groupBy("h", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = dense_key(classes, ["h"], "node")
    rows = materialise(live.join(classes.select("h", "v", "node"), ["h", "v"]).select("vec_id", "node"), "nn-rows")
    classes = classes.drop("h")
    members = bundles(classes, classes.count(), threshold)
    grouped = members.join(classes.select("node", "size"), "node").groupBy(F.col("leader").alias("node")).agg(
        F.sum("size").alias("rows"), F.count("*").alias("n"), F.min("cosine").alias("cosine")
    )
    radius = F.when(F.col("n") > 1, F.acos(F.least(F.col("cosine"), F.lit(1.0))) + SLACK).otherwise(F.lit(0.0))
    nodes = materialise(grouped.select("node", "rows", "n", radius.alias("radius")).join(classes.select("node", "v"), "node"), "nn-nodes")

    near, recall = near_bundles(rows, classes, members, nodes, threshold)
    sizes = nodes.select("node", "rows", "n", "radius")
    sided = near.join(sizes.toDF("a", "rows_a", "n_a", "radius_a"), "a").join(sizes.toDF("b", "rows_b", "n_b", "radius_b"), "b")
    wide = F.col("radius_a") + F.col("radius_b")
    whole = (wide == 0) | (F.acos(F.least("cosine", F.lit(1.0))) + wide + SLACK <= acos(threshold))
    sided = materialise(sided.withColumn("whole", whole), "nn-sided")
    full = sided.where("whole")
    part = materialise(_member_links(sided.where("NOT whole"), members, classes, nodes, threshold), "nn-part")

    all_of = full.select(F.col("a").alias("leader"), F.col("rows_b").alias("m")).unionByName(
        full.select(F.col("b").alias("leader"), F.col("rows_a").alias("m"))
    ).groupBy("leader").agg(F.sum("m").alias("all_of"))
    some_of = part.groupBy("node").agg(F.sum("more").alias("some_of"))
    linked = full.select("a", "b").unionByName(part.select("a", "b")).distinct()
    roots = components(linked, "nn-components").withColumnRenamed("node", "leader")
    rooted = members.join(roots, "leader", "left").select("node", "leader", F.coalesce("root", "leader").alias("root"))
    rooted = materialise(rooted.join(classes.select("node", "least"), "node"), "nn-rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    none = F.lit(0).cast("long")
    named = (
        rooted.join(least, "root")
        .join(sizes.select(F.col("node").alias("leader"), "rows"), "leader")
        .join(all_of, "leader", "left")
        .join(some_of, "node", "left")
        .select(
            "node",
            F.col("least").alias("class_id"),
            (F.col("rows") - 1 + F.coalesce("all_of", none) + F.coalesce("some_of", none)).alias("n_links"),
            "component_id",
        )
    )
    found = rows.join(named, "node").select("vec_id", "n_links", "component_id", "class_id")
    alone = clean.where("v IS NULL").select(
        "vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").alias("class_id")
    )
    return found.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), "class_id",
        F.lit(recall).cast("double").alias("recall"),
    )
