"""The whole selection as phases, each a DataFrame to DataFrame step, with results kept for a restart."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import seq as S
from tilewright.operators import cluster, homology, identify, select, tiling, tree
from tilewright.operators.intervals import collapse_runs, merge_intervals, subtract_intervals
from tilewright.params import Params
from tilewright.session import materialize
from tilewright.sources import outputs
from tilewright.sources.tables import numbered

log = logging.getLogger(__name__)


class Phases:
    """Runs named steps; with a folder, a step whose finished output for the same ``key`` (a digest of the parameters) is there is read instead of run."""

    def __init__(self, spark: SparkSession, folder: str | None = None, force: bool = False, key: str = ""):
        self.spark, self.folder, self.force = spark, f"{folder}/{key}" if folder and key else folder, force

    def done(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def run(self, name: str, step: Callable[[], DataFrame]) -> DataFrame:
        if not self.folder:
            return materialize(step(), name)
        path = f"{self.folder}/{name}"
        if self.force or not self.done(path):
            step().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def candidate_regions(clusters: DataFrame, p: Params) -> DataFrame:
    """clusters(cluster_id, node_id, seq of ACGT) -> node_id, cluster_id, pos, len, seq: runs of windows unique to their node, within the GC and Tm limits and no more than max_identity like any window of another node.

    Cheap filters come first: uniqueness and GC are native; melting temperatures are computed once and cut to the best interval; similarity to other nodes, on both strands, comes last.
    """
    seqs = clusters.withColumnRenamed("cluster_id", "id")
    low, high = p.gc_bounds
    unique = identify.unique_starts(seqs, p.length, p.contiguity, p.first)
    windows = identify.gc_windows(seqs, p.length, low, high, p.first)
    ok = windows.join(unique.select("id", F.explode(F.sequence("s", F.col("e") - 1)).alias("pos")), ["id", "pos"], "left_semi")
    tms = materialize(identify.window_tm(seqs, p.length, p.first).join(ok.select("id", "pos"), ["id", "pos"], "left_semi").join(seqs.select("id", "node_id"), "id"), "tm")
    if p.tm_min is None and p.tm_max is None:
        best = identify.best_tm_interval(tms, p.tm_range).first()  # one row
        t_low, t_high = (best.low, best.high) if best and best.low is not None else (None, None)
    else:
        t_low, t_high = p.tm_min, p.tm_max
    kept = tms
    if t_low is not None:
        kept = kept.where(F.floor(F.col("tm") * 100) >= round(t_low * 100))
    if t_high is not None:
        kept = kept.where(F.floor(F.col("tm") * 100) < round(t_high * 100))
    kept = materialize(kept, "within-tm")
    alike = homology.similar_starts(seqs.join(kept.select("id").distinct(), "id", "left_semi"), seqs, p.length, p.max_identity + 1)
    kept = kept.join(alike.select("id", F.explode(F.sequence("s", F.col("e") - 1)).alias("pos")), ["id", "pos"], "left_anti")
    if p.candidates:
        starts = identify.middle_of_runs(collapse_runs(kept, ["node_id", "id"]).select("node_id", "id", F.col("pos").alias("s"), (F.col("pos") + F.col("n")).alias("e")), p.candidates)
        regions = starts.select("node_id", "id", "pos", F.lit(p.length).alias("len"))
    else:
        regions = collapse_runs(kept, ["node_id", "id"], length=p.length).drop("n")
    return regions.join(seqs.select("id", "seq"), "id").select("node_id", F.col("id").alias("cluster_id"), "pos", F.col("len").cast("int").alias("len"), F.substring(F.col("seq"), F.col("pos"), F.col("len")).alias("seq"))


def filter_regions(regions: DataFrame, p: Params, blacklists: list[DataFrame] | None = None) -> DataFrame:
    """regions(region_id, node_id, cluster_id, pos, len, seq) without low complexity and blacklisted stretches, pieces of at least a probe.

    blacklists: tables (id, seq), one after another; the chain ends early once nothing is left.
    """

    def cut(regions: DataFrame, intervals: DataFrame) -> DataFrame:
        whole = regions.select("region_id", F.lit(1).alias("s"), (F.col("len") + 1).alias("e"))
        left = subtract_intervals(whole, intervals, ["region_id"], min_length=p.length)
        j = left.join(regions, "region_id")
        return j.select(
            F.concat_ws("_", "region_id", F.col("piece").cast("string")).alias("region_id"), "node_id", "cluster_id",
            (F.col("pos") + F.col("s") - 1).alias("pos"), (F.col("e") - F.col("s")).cast("int").alias("len"), F.substring(F.col("seq"), F.col("s"), F.col("e") - F.col("s")).alias("seq"),
        )

    seqs = regions.select(F.col("region_id").alias("id"), "seq")
    out = materialize(cut(regions, homology.dust_intervals(seqs, p.lcr_window, p.lcr_threshold).withColumnRenamed("id", "region_id")), "masked")
    for black in blacklists or []:
        if out.isEmpty():
            break
        seqs = out.select(F.col("region_id").alias("id"), "seq")
        shared = homology.seed_hits(seqs, black, min(p.contiguity, p.hit_length))
        found = homology.similar_spans(shared, seqs, black, p.hit_length, -(-int(p.hit_identity * p.hit_length) // 100))
        # windows as like a black-listed one as two nodes may not be, on either strand
        alike = homology.similar_spans(homology.spaced_hits(seqs, black), seqs, black, p.length, p.max_identity + 1)
        both = found.select("a_id", "s", "e").unionByName(alike.select("a_id", "s", "e"))
        spans = merge_intervals(both.select(F.col("a_id").alias("region_id"), "s", "e"), ["region_id"])
        out = materialize(cut(out, spans), "filtered")
    return out


def select_probes(regions: DataFrame, nodes: DataFrame, p: Params, budget: int) -> DataFrame:
    """regions on nodes of a tree -> probes. Regions of an inner node count for every leaf below it; of a node that isn't in the tree, for itself.

    regions may have target_rank (lower first). Caps on regions and probes per organism come first; then everything at its densest if that fits, one density for
    all (constant_tiling), or densities by what each organism lacks; what is beyond the budget is trimmed. auto_tune finds the caps that aren't given.
    """
    region_org = materialize(select.expand_leaves(regions, nodes), "region-org")
    bounded = materialize(select.with_bounds(regions, p.length, p.density), "bounded")
    rank = ["target_rank"] if "target_rank" in bounded.columns else []
    spread = select.spread_order(region_org.join(bounded.select("region_id", "len", "pos", *rank), "region_id"), ["org"])
    firsts = [F.first(c).alias(c) for c in ("len", *rank)]
    ordered = materialize(select.priority_order(region_org, spread.groupBy("region_id").agg(F.min("spread").alias("spread"), *firsts)), "ordered")
    least = materialize(ordered.groupBy("region_id").agg(F.min("priority").alias("priority")), "priorities")
    most = p.max_regions
    if budget and p.auto_tune and not most:
        most = tiling.tune_regions(ordered, bounded.withColumn("probes", F.col("n_lo")), budget)
    if most:
        region_org = materialize(select.cap_regions(region_org, ordered, most), "capped")
        bounded = materialize(bounded.join(region_org.select("region_id").distinct(), "region_id", "left_semi"), "bounded")
    sized = bounded.withColumn("probes", F.col("n_lo")).join(least, "region_id")
    most_baits = p.max_baits
    if budget and p.auto_tune and not most_baits:
        most_baits = tiling.best_cap(select.needed_baits(sized, region_org), budget, p.min_baits)
    if most_baits:
        held = select.cap_baits(region_org, sized, most_baits)
        bounded = materialize(held.drop("probes", "priority"), "bounded")
        region_org = materialize(region_org.join(bounded.select("region_id"), "region_id", "left_semi"), "capped")
    top = bounded.agg(F.sum("n_hi").alias("n")).first().n or 0
    if not budget or top <= budget:
        tiled = bounded.withColumn("density", F.col("hi"))
    else:
        if p.constant_tiling:
            one = select.constant_density(bounded, p.length, budget).first()  # one row, or none if not even a single probe a place fits
            density = F.least(F.col("hi"), F.lit(one.density if one else 1))
            tiled = materialize(bounded.withColumns({"density": density, "probes": select.bait_count(F.col("len"), density, p.length)}), "tiled")
        else:
            _, kinds = tiling.classify(bounded, region_org, budget)
            tiled = tiling.target_densities(bounded, region_org, kinds, ordered, budget, p.length)
        tiled = tiling.trim(tiled, region_org, ordered, budget, p.min_baits, p.length)
    return select.emit_probes(tiled, p.length)


def design(spark: SparkSession, genes: DataFrame, p: Params, nodes: DataFrame | None = None, guide: DataFrame | None = None, blacklists: list[DataFrame] | None = None, folder: str | None = None, force: bool = False, first: list[str] | None = None) -> dict[str, DataFrame]:
    """genes(family, uid, taxon_id, seq) -> every phase's table: clusters, members, assignment, nodes, placed (clusters on their nodes), candidates, filtered, probes, and counts of what is left.

    first: names of clusters whose regions go before those of others, in this order.

    nodes: the tree to assign to; else a consensus of the clusters' groupings, with those of a guide tree(node_id, parent_id, is_leaf) if there is one.
    """
    log.info("parameters:\n%s", p.banner())
    phases = Phases(spark, folder, force, p.digest())
    clusters, members = cluster.cluster_genes(genes, p.divergence, p.translation_table, p.reroot)
    clusters, members = phases.run("clusters", lambda: clusters), phases.run("members", lambda: members.join(genes.select("uid", "taxon_id"), "uid"))
    nodes = nodes if nodes is not None else phases.run("nodes", lambda: tree.consensus_tree(spark, members, p.guide_weight, guide))
    assigned = phases.run("assignment", lambda: tree.relabel_low(tree.assign_lca(members, nodes), p.penetrance))
    placed = identify.pseudo_genomes(clusters.join(assigned.select("cluster_id", "node_id"), "cluster_id").withColumn("seq", F.upper("seq")), p.length + p.flank)
    # runs of ACGT are searched each for itself; what they share with other nodes still counts
    runs = S.segments_of_acgt(placed.select("cluster_id", "node_id", "seq")).withColumn("cluster_id", F.concat_ws("@", "cluster_id", F.col("offset").cast("string"))).drop("offset")
    found = phases.run("candidates", lambda: numbered(_unsplit(candidate_regions(materialize(runs, "runs"), p)), ["node_id", "cluster_id", "pos"], "BR_", 6, "region_id"))
    found = found.where(F.col("node_id") != "_LOWPEN_")
    kept = phases.run("filtered", lambda: outputs.renumber_filtered(filter_regions(found, p, blacklists)))
    if first:
        ranks = spark.createDataFrame([(c, i) for i, c in enumerate(dict.fromkeys(first))], "cluster_id string, target_rank int")
        kept = kept.join(F.broadcast(ranks), "cluster_id", "left").na.fill(len(first), ["target_rank"])  # as many rows as the caller named
    budget = p.with_genomes(genes.select("taxon_id").distinct().count()).probes
    probes = phases.run("probes", lambda: numbered(select_probes(kept, nodes, p, budget), ["region_id", "clust_pos"], "Probe_", 6, "probe_id"))
    left = [outputs.counts(df, F.col(key), F.col("node_id")).select(F.lit(stage).alias("stage"), "regions", "taxa") for stage, df, key in (("candidates", found, "region_id"), ("filtered", kept, "region_id"), ("probes", probes, "probe_id"))]
    counts = phases.run("counts", lambda: left[0].unionByName(left[1]).unionByName(left[2]))
    for r in counts.collect():  # three rows
        log.info("%s: %d regions of %d taxa", r.stage, r.regions, r.taxa)
    return {"clusters": clusters, "members": members, "assignment": assigned, "nodes": nodes, "placed": placed, "candidates": found, "filtered": kept, "probes": probes, "counts": counts}


def probe_summary(out: dict[str, DataFrame], p: Params, budget: int) -> DataFrame:
    """The tables of design -> org, probes, class: what each organism gets, those with fewest first."""
    spark = out["probes"].sparkSession
    region_org = materialize(select.expand_leaves(out["filtered"], out["nodes"]), "region-org")
    _, kinds = tiling.classify(select.with_bounds(out["filtered"], p.length, p.density), region_org, budget)
    sized = out["probes"].groupBy("node_id").agg(F.count("*").alias("probes")).withColumn("region_id", F.col("node_id"))
    return outputs.summary(sized, select.expand_leaves(sized, out["nodes"]), spark.createDataFrame(list(kinds.items()), "org string, class string"))


def _unsplit(regions: DataFrame) -> DataFrame:
    """Positions on runs back to positions on clusters."""
    at = F.split("cluster_id", "@")
    return regions.withColumns({"pos": F.col("pos") + F.element_at(at, -1).cast("int"), "cluster_id": F.regexp_replace("cluster_id", "@[0-9]+$", "")})
