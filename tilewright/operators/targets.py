"""From probes on clusters back to regions of the genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.functions import cigar, seq as S
from tilewright.operators.intervals import merge_intervals


def collapse_probes(probes: DataFrame, probe: int) -> DataFrame:
    """probes(taxon_id, cluster_id, clust_pos) -> taxon_id, cluster_id, s, e: overlapping or touching ones merged, half-open, 1-based."""
    return merge_intervals(probes.select("taxon_id", "cluster_id", F.col("clust_pos").alias("s"), (F.col("clust_pos") + probe).alias("e")), ["taxon_id", "cluster_id"])


def genes_with_flanks(annotations: DataFrame, contigs: DataFrame, flank: int) -> DataFrame:
    """annotations(gene_id, path, chr, start, end, strand), contigs(path, chr, seq) -> + up, down (bases there were around the gene, in its own direction) and seq with these flanks."""
    j = annotations.join(contigs, ["path", "chr"])
    left, right = F.least(F.lit(flank), F.col("start") - 1), F.least(F.lit(flank), F.length("seq") - F.col("end"))
    cut = F.substring(F.col("seq"), F.col("start") - left, F.col("end") - F.col("start") + 1 + left + right)
    minus = F.col("strand") == "-"
    return j.select("gene_id", "path", "chr", "start", "end", "strand", F.when(minus, right).otherwise(left).alias("up"), F.when(minus, left).otherwise(right).alias("down"), F.when(minus, S.revcomp(F.upper(cut))).otherwise(F.upper(cut)).alias("seq"))


def target_regions(regions: DataFrame, members: DataFrame, genes: DataFrame, probe: int, flank: int) -> DataFrame:
    """regions(taxon_id, cluster_id, s, e) on clusters, members(cluster_id, taxon_id, gene_id, cigar), genes as from genes_with_flanks
    -> taxon_id, cluster_id, gene_id, chr, start, end, strand, seq: each region on each member, with flanks, clamped to what there is.

    Regions that keep less than half a probe of the member, or end up shorter than a probe, go. A member without a CIGAR is taken to equal its cluster.
    """
    of_cluster = regions.groupBy("cluster_id").agg(F.collect_list(F.struct("s", (F.col("e") - 1).alias("t"))).alias("_at"))  # a cluster's regions lie on its one sequence
    where = ["path"] if "path" in genes.columns else []
    j = of_cluster.join(members, "cluster_id").join(genes.select("gene_id", *where, "chr", "start", "end", "strand", "up", "down", "seq"), "gene_id")
    s, e = F.transform("_at", lambda x: x["s"]), F.transform("_at", lambda x: x["t"])
    own = F.length("seq") - F.col("up") - F.col("down")
    # all of a member's regions at once: its CIGAR is read once for either end
    j = j.withColumns({"_s": F.when(F.col("cigar").isNull(), s).otherwise(cigar.adjust_all(s, F.col("cigar"), True)), "_e": F.when(F.col("cigar").isNull(), e).otherwise(cigar.adjust_all(e, F.col("cigar")))})
    both = F.transform(F.arrays_zip("_s", "_e"), lambda x: F.struct(F.greatest(F.lit(1), F.coalesce(x["_s"], own + 1)).alias("a"), F.least(F.coalesce(x["_e"], own), own).alias("b")))
    kept = F.filter(both, lambda x: x["b"] - x["a"] + 1 >= (probe + 1) // 2)
    wide = F.transform(kept, lambda x: F.struct(F.greatest(1 - F.col("up"), x["a"] - flank).alias("x"), F.least(F.length("seq") - F.col("up"), x["b"] + flank).alias("y")))
    long_ = F.filter(wide, lambda x: x["y"] - x["x"] + 1 >= probe)
    cut = F.transform(long_, lambda x: F.struct(x["x"].alias("x"), x["y"].alias("y"), F.substring(F.col("seq"), x["x"] + F.col("up"), x["y"] - x["x"] + 1).alias("seq")))
    j = j.select("taxon_id", "cluster_id", "gene_id", *where, "chr", "start", "end", "strand", F.inline(cut))
    minus = F.col("strand") == "-"
    return j.select(
        "taxon_id", "cluster_id", "gene_id", *where, "chr",
        F.when(minus, F.col("end") - F.col("y") + 1).otherwise(F.col("start") + F.col("x") - 1).alias("start"),
        F.when(minus, F.col("end") - F.col("x") + 1).otherwise(F.col("start") + F.col("y") - 1).alias("end"),
        "strand", "seq",
    )


def merge_targets(targets: DataFrame) -> DataFrame:
    """Overlapping target regions of a contig as one, half-open: taxon_id, chr, s, e."""
    return merge_intervals(targets.select("taxon_id", "chr", F.col("start").alias("s"), (F.col("end") + 1).alias("e")), ["taxon_id", "chr"])


def plan_targets(probes: DataFrame, members: DataFrame, genes: DataFrame, probe: int, flank: int, overlap: str = "context") -> DataFrame:
    """probes(taxon_id, cluster_id, clust_pos) -> the genomes' regions that they are meant for, with their flanks.

    overlap: ``context`` merges overlapping probes and then overlapping regions (taxon_id, chr, s, e), ``probe`` only the probes, ``none`` leaves each probe's region alone.
    """
    if overlap not in ("context", "probe", "none"):
        raise ValueError("overlap must be context, probe or none")
    if overlap == "none":
        regions = probes.select("cluster_id", F.col("clust_pos").alias("s"), (F.col("clust_pos") + probe).alias("e"))
    else:
        regions = collapse_probes(probes, probe).select("cluster_id", "s", "e")
    probed = probes.select("cluster_id").distinct()
    found = target_regions(regions.distinct(), members.join(probed, "cluster_id", "left_semi"), genes, probe, flank)
    return merge_targets(found) if overlap == "context" else found


def joined_targets(targets: DataFrame, contigs: DataFrame) -> DataFrame:
    """Overlapping or touching targets(taxon_id, path, chr, start, end, cluster_id) as one: taxon_id, path, chr, start, end, strand (+), cluster_id (all, by name), seq, cut from contigs(path, chr, seq) once more."""
    key = ["taxon_id", "path", "chr"]
    order = W.partitionBy(*key).orderBy("start", "end", "cluster_id")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = targets.select(*key, "start", "end", "cluster_id").withColumn("_new", F.coalesce(F.col("start") > before + 1, F.lit(True)).cast("int"))
    islands = marked.withColumn("_island", F.sum("_new").over(order)).groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.concat_ws(",", F.array_sort(F.collect_set("cluster_id"))).alias("cluster_id"))
    cut = islands.join(contigs.select("path", "chr", F.col("seq").alias("_seq")), ["path", "chr"])
    return cut.select(*key, "start", "end", F.lit("+").alias("strand"), "cluster_id", F.upper(F.substring(F.col("_seq"), F.col("start"), F.col("end") - F.col("start") + 1)).alias("seq"))
