"""Choosing a balanced tiling of regions within a budget of probes.

Regions: region_id, len, ...; region_org(region_id, org) says which organisms a region covers. A region's density is
the number of probes that cover a base.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.operators import tree
from tilewright.session import materialize


def max_density(length: Column, probe: int) -> Column:
    return F.when(length >= 2 * probe - 1, F.lit(probe)).otherwise(length - probe + 1)


def min_density(length: Column, probe: int, least: int) -> Column:
    return F.least(max_density(length, probe), F.lit(least))


def spacing(length: Column, density: Column, probe: int) -> Column:
    """Distance between probes' starts."""
    close = F.when(length < 2 * probe, F.floor((length - probe) / (density - 1))).otherwise(F.floor(F.lit(probe - 1) / (density - 1)))
    return F.when(density <= 1, F.lit(probe).cast("long")).otherwise(F.greatest(F.lit(1).cast("long"), close)).cast("long")


def bait_count(length: Column, density: Column, probe: int) -> Column:
    return F.ceil((length - probe + 1) / spacing(length, density, probe)).cast("long")


def with_bounds(regions: DataFrame, probe: int, least: int) -> DataFrame:
    """Adds lo, hi (densities) and n_lo, n_hi (probes at these)."""
    n = F.col("len")
    out = regions.withColumns({"hi": max_density(n, probe).cast("int"), "lo": min_density(n, probe, least).cast("int")})
    return out.withColumns({"n_lo": bait_count(n, F.col("lo"), probe), "n_hi": bait_count(n, F.col("hi"), probe)})


def expand_leaves(regions: DataFrame, nodes: DataFrame) -> DataFrame:
    """regions(region_id, node_id), nodes(node_id, parent_id, is_leaf) -> region_id, org: the leaves below each region's node; a node that isn't in the tree counts for itself."""
    up = tree.closure(nodes).join(nodes.where("is_leaf").select("node_id"), "node_id").select(F.col("ancestor").alias("node_id"), F.col("node_id").alias("leaf"))
    up = materialize(up, "leaves")  # a row per node and leaf below it: Spark knows its size and can send it to the regions
    return regions.select("region_id", "node_id").join(up, "node_id", "left").select("region_id", F.coalesce("leaf", "node_id").alias("org"))


def baits_per_org(bounded: DataFrame, region_org: DataFrame) -> DataFrame:
    return region_org.join(bounded.select("region_id", "n_lo", "n_hi"), "region_id").groupBy("org").agg(F.sum("n_lo").alias("n_lo"), F.sum("n_hi").alias("n_hi"), F.count("*").alias("regions"))


def constant_density(regions: DataFrame, probe: int, budget: int) -> DataFrame:
    """The largest density d, applied to every region up to its own most, whose probes fit the budget: density, probes; no row if none fits."""
    n = F.col("len")
    each = regions.select("len", F.explode(F.sequence(F.lit(1), F.lit(probe))).alias("density"))
    own = F.least(F.col("density"), max_density(n, probe))
    totals = each.groupBy("density").agg(F.sum(bait_count(n, own, probe)).alias("probes")).where(F.col("probes") <= budget)
    return totals.select(F.max(F.struct("density", "probes")).alias("b")).where("b is not null").select("b.density", "b.probes")


def max_spread(positions: list) -> list:
    """Sorted, distinct positions: ends first, then between two chosen always the first at or past their middle (else the last before the second), breadth first."""
    n = len(positions)
    if n <= 2:
        return list(positions)
    out, queue = [positions[0], positions[-1]], [(0, n - 1)]
    for a, b in queue:
        if b - a < 2:
            continue
        k = min(bisect_left(positions, (positions[a] + positions[b]) / 2, a + 1, b), b - 1)
        out.append(positions[k])
        queue += [(a, k), (k, b)]
    return out


def spread_order(regions: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Adds spread: a region's place (from 0) in the max-spread order of its key."""
    fields = regions.schema.fieldNames()

    def order(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values([pos, "region_id"]).reset_index(drop=True)
        first = df.drop_duplicates(pos)
        place = {p: i for i, p in enumerate(max_spread(first[pos].tolist()))}
        return df.assign(spread=df[pos].map(place).astype("int32"))[[*fields, "spread"]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in regions.schema)
    return regions.groupBy(*keys).applyInPandas(order, f"{kinds}, spread int")


def priority_order(region_org: DataFrame, regions: DataFrame) -> DataFrame:
    """Each organism's regions in order: those of fewest organisms first, then target rank, spread, shorter, region_id. Missing rank or spread counts as 0."""
    own = regions.select("region_id", "len", *(c for c in ("target_rank", "spread") if c in regions.columns))
    shared = region_org.withColumn("n_org", F.count("*").over(W.partitionBy("region_id")))
    extra = [F.col(c) for c in ("target_rank", "spread") if c in own.columns]
    order = W.partitionBy("org").orderBy("n_org", *extra, "len", "region_id")
    return shared.join(own, "region_id").select("org", "region_id", "n_org", "len", F.row_number().over(order).alias("priority"))


def needed_baits(tiled: DataFrame, region_org: DataFrame) -> DataFrame:
    """tiled(region_id, probes, priority) -> region_id, probes, need: probes that an organism must be allowed for it to keep the region, by the organism that asks least; 0 for an organism's first."""
    held = region_org.join(tiled.select("region_id", "probes", "priority"), "region_id")
    order = W.partitionBy("org").orderBy("priority", "region_id")
    upto = F.when(F.row_number().over(order) == 1, 0).otherwise(F.sum("probes").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return held.withColumn("need", upto).groupBy("region_id").agg(F.min("need").alias("need"), F.first("probes").alias("probes"))


def cap_regions(region_org: DataFrame, ordered: DataFrame, most: int) -> DataFrame:
    """Pairs (region_id, org) of regions that some organism has among its first ``most``: a region goes only if every organism that shares it can spare it."""
    keep = ordered.where(F.col("priority") <= most).select("region_id").distinct()
    return region_org.join(keep, "region_id", "left_semi")


def cap_baits(region_org: DataFrame, tiled: DataFrame, most: int) -> DataFrame:
    """tiled(region_id, probes, priority) -> the regions that some organism keeps within ``most`` probes; an organism's first region always stays."""
    return tiled.join(needed_baits(tiled, region_org).where(F.col("need") <= most).select("region_id"), "region_id", "left_semi")


def emit_probes(tiled: DataFrame, probe: int) -> DataFrame:
    """tiled(region_id, node_id, cluster_id, pos, len, density, seq) -> a row per probe: region_id, node_id, cluster_id, clust_pos, seq. The tiling is centred in its region.

    A column ``begin`` counts bases of seq before a region that was shortened to len.
    """
    n = F.col("len")
    step, count = spacing(n, F.col("density"), probe), bait_count(n, F.col("density"), probe)
    spare = n - probe - (count - 1) * step
    begin = F.col("begin") if "begin" in tiled.columns else F.lit(0)
    placed = tiled.withColumns({"_step": step, "_count": count}).withColumn("_start", begin + F.floor(spare / 2))
    each = placed.select("region_id", "node_id", "cluster_id", "pos", "seq", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1), lambda i: F.col("_start") + i * F.col("_step"))).alias("offset"))
    return each.select("region_id", "node_id", "cluster_id", (F.col("pos") + F.col("offset")).alias("clust_pos"), F.substring(F.col("seq"), (F.col("offset") + 1).cast("int"), F.lit(probe)).alias("seq"))
