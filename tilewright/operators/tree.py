"""Trees over taxa: closure, lowest common ancestors, bipartitions, and the consensus tree."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.session import materialize

#: Taxa in one word of a mask; a mask is an array of as many words as the taxa need.
WORD = 62


def closure(nodes: DataFrame) -> DataFrame:
    """nodes(node_id, parent_id) -> ancestor, node_id, distance, itself included.

    Paths are doubled: pairs less than 2**k apart, taken on from the node 2**k above, give those less than 2**(k + 1) apart. So a tree of any
    depth takes as many rounds as its depth has bits; each round's pairs are written once. A parent that is no node is an ancestor only. Nodes above themselves raise ValueError.
    """
    own = materialize(nodes.select("node_id", "parent_id"), "nodes")
    outside = materialize(own.where("parent_id is not null").select(F.col("parent_id").alias("node_id")).distinct().join(own.select("node_id"), "node_id", "left_anti"), "outside")
    pairs = own.select("node_id").unionByName(outside).select(F.col("node_id").alias("ancestor"), "node_id", F.lit(0).alias("distance"))
    hop, apart, most = own.where("parent_id is not null").select("node_id", F.col("parent_id").alias("top")), 1, own.count()
    while not hop.isEmpty():
        if apart > most:
            raise ValueError("a node is above itself")
        further = hop.join(pairs.select(F.col("node_id").alias("top"), "ancestor", "distance"), "top").select("ancestor", "node_id", (F.col("distance") + apart).alias("distance"))
        pairs = pairs.unionByName(materialize(further, "pairs"))
        hop = materialize(hop.join(hop.select(F.col("node_id").alias("top"), F.col("top").alias("next")), "top").select("node_id", F.col("next").alias("top")), "hops")
        apart *= 2
    return pairs.join(outside, "node_id", "left_anti").select("ancestor", "node_id", "distance")


def assign_lca(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """members(cluster_id, taxon_id), nodes(node_id, parent_id, is_leaf) -> cluster_id, node_id (deepest node above all its taxa), penetrance (percent of the node's leaves it has).

    Clusters with the same taxa are assigned once. Members may be repeated.
    """
    up = closure(nodes)
    leaf = nodes.where("is_leaf").select("node_id")
    under = up.join(leaf, "node_id").groupBy("ancestor").agg(F.count("*").alias("leaves"))
    depth = up.groupBy("node_id").agg(F.max("distance").alias("depth")).withColumnRenamed("node_id", "ancestor")
    sets = members.join(leaf.withColumnRenamed("node_id", "taxon_id"), "taxon_id", "left_semi").groupBy("cluster_id").agg(F.array_sort(F.collect_set("taxon_id")).alias("taxa"))
    sets = materialize(sets, "taxa-sets")  # read twice
    each = sets.select("taxa").distinct().select("taxa", F.explode("taxa").alias("node_id"))
    above = each.join(up, "node_id").groupBy("taxa", "ancestor").agg(F.count("*").alias("n")).where(F.col("n") == F.size("taxa"))
    best = above.join(depth, "ancestor").groupBy("taxa").agg(F.max_by("ancestor", "depth").alias("ancestor"))
    placed = best.join(under, "ancestor").select("taxa", F.col("ancestor").alias("node_id"), (100.0 * F.size("taxa") / F.col("leaves")).alias("penetrance"))
    placed = materialize(placed, "placed")  # a row per set of taxa: Spark knows its size and can send it to the clusters
    return sets.join(placed, "taxa").select("cluster_id", "node_id", "penetrance")


def relabel_low(assignment: DataFrame, least: float = 50.0, label: str = "_LOWPEN_", drop_label: bool = False) -> DataFrame:
    """Drops rows whose penetrance isn't a number in [0, 100]; those below ``least`` get the label. One row per cluster: passing before low, then by node."""
    p = F.expr("try_cast(penetrance as double)")
    rows = assignment.withColumn("penetrance", p).where(F.col("penetrance").between(0, 100))
    rows = rows.withColumn("_low", F.col("penetrance") < least)
    rows = rows.withColumn("node_id", F.when(F.col("_low"), F.lit(label)).otherwise(F.col("node_id")))
    first = W.partitionBy("cluster_id").orderBy("_low", "node_id", "penetrance")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_low")
    return rows.where(F.col("node_id") != label) if drop_label else rows


# ---------------------------------------------------------------- bipartitions


def taxon_index(taxa: DataFrame) -> DataFrame:
    """taxa(taxon_id) -> taxon_id, idx from 0 in order: a row per taxon."""
    return taxa.select("taxon_id").distinct().withColumn("idx", F.row_number().over(W.orderBy("taxon_id")) - 1)


def bits(mask: Column) -> Column:
    """Taxa in a mask."""
    return F.aggregate(mask, F.lit(0), lambda n, w: n + F.bit_count(w).cast("int"))


def _whole(n: int) -> list[int]:
    """The words of all n taxa."""
    return [(1 << min(WORD, n - at)) - 1 for at in range(0, max(n, 1), WORD)]


def as_int(mask: Iterable[int]) -> int:
    return sum(w << WORD * i for i, w in enumerate(mask))


def _bit(idx: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(idx, F.lit(WORD)).cast("int"))


def has_taxon(mask: Column, idx: Column) -> Column:
    return mask[F.floor(idx / WORD).cast("int")].bitwiseAND(_bit(idx)) != 0


def normal_side(mask: Column, n: int) -> Column:
    """The smaller side of a split; of equal sides the one without the last taxon."""
    size = bits(mask)
    flip = (2 * size > n) | ((2 * size == n) & has_taxon(mask, F.lit(n - 1)))
    full = F.array(*(F.lit(w).cast("long") for w in _whole(n)))
    return F.when(flip, F.zip_with(mask, full, lambda a, b: a.bitwiseXOR(b))).otherwise(mask)


def cluster_masks(members: DataFrame, index: DataFrame, n: int | None = None) -> DataFrame:
    """members(cluster_id, taxon_id) -> cluster_id, mask of its taxa. n: taxa in the index, counted if not given."""
    words = len(_whole(index.count() if n is None else n))
    word, bit = F.floor(F.col("idx") / WORD).cast("int"), _bit(F.col("idx"))
    parts = members.join(index, "taxon_id").groupBy("cluster_id", word.alias("w")).agg(F.bit_or(bit).alias("bits"))
    of = parts.groupBy("cluster_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("of"))
    return of.select("cluster_id", F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.coalesce(F.try_element_at(F.col("of"), w), F.lit(0).cast("long"))).alias("mask"))


def guide_masks(nodes: DataFrame, index: DataFrame, n: int | None = None) -> DataFrame:
    """A guide tree's nodes(node_id, parent_id, is_leaf) -> mask: the known taxa below each inner node but the root, two or more."""
    inner = nodes.where("not is_leaf and parent_id is not null").select(F.col("node_id").alias("ancestor"))
    below = closure(nodes).join(inner, "ancestor", "left_semi").join(nodes.where("is_leaf").select("node_id"), "node_id", "left_semi")
    masks = cluster_masks(below.select(F.col("ancestor").alias("cluster_id"), F.col("node_id").alias("taxon_id")), index, n)
    return masks.where(bits(F.col("mask")) >= 2).select("mask").distinct()


def count_bipartitions(masks: DataFrame, n: int, weight: float = 1.0, guide: DataFrame | None = None) -> DataFrame:
    """Weighted splits: each cluster adds ``weight``, each guide split (mask) of 2 taxa or more adds 1, equal ones (also the two sides at a guide's root) once."""
    own = masks.select(normal_side(F.col("mask"), n).alias("mask"), F.lit(float(weight)).alias("w"))
    if guide is not None:
        own = own.unionByName(guide.where(bits(F.col("mask")) >= 2).select(normal_side(F.col("mask"), n).alias("mask")).distinct().withColumn("w", F.lit(1.0)))
    return own.where(bits(F.col("mask")) > 0).groupBy("mask").agg(F.sum("w").alias("count")).withColumn("size", bits(F.col("mask")))


def subset(a: Column, b: Column) -> Column:
    """Whether every taxon of mask a is in mask b."""
    return F.forall(F.zip_with(a, b, lambda x, y: x.bitwiseAND(F.bitwise_not(y))), lambda x: x == 0)


def disjoint(a: Column, b: Column) -> Column:
    return F.forall(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)), lambda x: x == 0)


def compatible(a: Column, b: Column) -> Column:
    """Both splits fit one tree: disjoint or nested (masks of normal sides)."""
    return disjoint(a, b) | subset(a, b) | subset(b, a)


def cull(splits: Iterable[tuple[int, float, int]]) -> list[int]:
    """Greedy choice of splits (mask, count, size): most counted first, then larger, then smaller mask; one that contradicts a kept one goes."""
    kept: list[int] = []
    for mask, _, _ in sorted(splits, key=lambda x: (-x[1], -x[2], x[0])):
        if all(mask & k in (0, mask, k) for k in kept):
            kept.append(mask)
    return kept


def rarest_taxa(masks: DataFrame, index: DataFrame) -> DataFrame:
    """Taxa in the fewest groupings of two or more: the outgroup, ties included."""
    several = masks.where(bits(F.col("mask")) >= 2).groupBy("mask").agg(F.count("*").alias("clusters"))
    held = several.select("clusters", F.posexplode("mask").alias("w", "word"))
    taxa = index.withColumn("w", F.floor(F.col("idx") / WORD).cast("int"))
    bit = _bit(F.col("idx"))
    seen = taxa.join(held, (taxa["w"] == held["w"]) & (F.col("word").bitwiseAND(bit) != 0), "left").groupBy("taxon_id").agg(F.coalesce(F.sum("clusters"), F.lit(0)).alias("n"))
    return seen.withColumn("_r", F.rank().over(W.orderBy("n"))).where("_r = 1").drop("_r")


def build_tree(masks: Iterable[int], taxa: list[str], outgroup: Iterable[str] = ()) -> list[tuple[str, str | None, bool]]:
    """Compatible splits -> (node_id, parent_id, is_leaf), inner nodes IN_00000 from the root down.

    The root lies on the branch above the lowest common ancestor of the outgroup: the smallest side of a split that holds all of it. Every split then counts
    on its side within that or within the rest. Where no side holds the outgroup (or there is none), the root lies beside one taxon, the first of the outgroup.
    """
    n = len(taxa)
    full, out = (1 << n) - 1, sum(1 << taxa.index(t) for t in set(outgroup))
    both = {side for m in masks for side in (m, full ^ m)} | {1 << i for i in range(n)} | {full ^ 1 << i for i in range(n)}
    holds = [m for m in both if out and m & out == out and m != full]
    first = min(((m.bit_count(), m) for m in holds), default=(0, 1 << min((taxa.index(t) for t in outgroup), default=0)))[1]
    rest = full ^ first
    sides = {m if m & first in (0, m) else full ^ m for m in masks} | {first, rest}
    kept = sorted({full, *(c for c in sides if c.bit_count() >= 2)}, key=lambda c: (-c.bit_count(), c))
    names = {c: f"IN_{i:05d}" for i, c in enumerate(kept)}
    rows: list[tuple[str, str | None, bool]] = []
    for i, c in enumerate(kept):
        above = [k for k in kept[:i] if k & c == c]
        rows.append((names[c], names[min(above, key=int.bit_count)] if above else None, False))
    for i, taxon in enumerate(taxa):
        above = [k for k in kept if k >> i & 1]
        rows.append((taxon, names[min(above, key=int.bit_count)] if above else None, True))
    return rows


def consensus_tree(spark: SparkSession, members: DataFrame, weight: float = 1.0, guide: DataFrame | None = None, root: bool = True) -> DataFrame:
    """members(cluster_id, taxon_id), guide tree nodes(node_id, parent_id, is_leaf) -> nodes. Different splits and taxa, few by nature, meet on the driver."""
    index = taxon_index(members)
    taxa = [r.taxon_id for r in index.orderBy("idx").collect()]
    masks = cluster_masks(members, index, len(taxa))
    known = guide_masks(guide, index, len(taxa)) if guide is not None else None
    counted = count_bipartitions(masks, len(taxa), weight, known).where(F.col("size") >= 2).collect()
    splits = [(as_int(r.mask), r["count"], r["size"]) for r in counted]
    outgroup = [r.taxon_id for r in rarest_taxa(masks, index).collect()] if root else []
    return spark.createDataFrame(build_tree(cull(splits), taxa, outgroup), "node_id string, parent_id string, is_leaf boolean")
