"""Result files: tab-separated tables, FASTA and summaries, written by Spark in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.sources.fasta import write_fasta
from tilewright.sources.tables import numbered, write_table


def write_cluster_info(members: DataFrame, path: str) -> None:
    """members(cluster_id, taxon_id, seq_id, gene_id, start, end, strand, cigar) under the header of CLUSTER_INFO."""
    names = {"cluster_id": "ClusterID", "taxon_id": "TaxonID", "seq_id": "SeqID", "gene_id": "GeneID", "start": "Start", "end": "End", "strand": "Strand", "cigar": "CIGAR"}
    write_table(members.select(*(F.col(c).alias(name) for c, name in names.items())).orderBy("ClusterID", "TaxonID", "GeneID"), path)


def write_assignment(assignment: DataFrame, path: str) -> None:
    """assignment(cluster_id, node_id, penetrance), the penetrance with two decimals."""
    rows = assignment.select(F.col("cluster_id").alias("ClusterID"), F.col("node_id").alias("TaxonID"), F.format_string("%.2f", F.col("penetrance").cast("double")).alias("Penetrance"))
    write_table(rows.orderBy("ClusterID"), path)


def write_pseudo_genomes(placed: DataFrame, path: str) -> None:
    """placed(node_id, ord, seq) as FASTA: a record per node, its clusters in order with a line n between. Lines are sorted over all files, so no record is built in one place."""
    first = F.col("ord") == 1
    line = F.when(first, F.concat(F.lit(">"), "node_id", F.lit("\n"))).otherwise("n\n")
    ranged = placed.repartitionByRange("node_id", "ord").sortWithinPartitions("node_id", "ord")
    ranged.select(F.concat(line, F.upper("seq")).alias("value")).write.text(path)


def write_low_penetrance(clusters: DataFrame, assignment: DataFrame, path: str, label: str = "_LOWPEN_") -> None:
    """clusters(cluster_id, seq) whose assignment carries the label, as FASTA."""
    low = clusters.join(assignment.where(F.col("node_id") == label), "cluster_id", "left_semi")
    write_fasta(low.select(F.col("cluster_id").alias("id"), "seq").orderBy("id"), path)


def renumber_filtered(filtered: DataFrame) -> DataFrame:
    """filtered(region_id, node_id, cluster_id, pos, len, seq) with ids FBR_000000 and on, by node, cluster and place."""
    return numbered(filtered.drop("region_id"), ["node_id", "cluster_id", "pos"], "FBR_", 6, "region_id").select("region_id", "node_id", "cluster_id", "pos", "len", "seq")


def write_regions(regions: DataFrame, path: str) -> None:
    """Candidate or filtered regions without a header, by id."""
    write_table(regions.select("region_id", "node_id", "cluster_id", "pos", "len", "seq").orderBy("region_id"), path, header=False)


def write_probes(probes: DataFrame, fasta: str, info: str) -> None:
    """probes(probe_id, node_id, cluster_id, clust_pos, seq) as FASTA and as a table."""
    write_fasta(probes.select(F.col("probe_id").alias("id"), "seq").orderBy("id"), fasta)
    names = {"probe_id": "ProbeID", "node_id": "TaxonID", "cluster_id": "ClustID", "clust_pos": "ClustPos"}
    write_table(probes.select(*(F.col(c).alias(name) for c, name in names.items())).orderBy("ProbeID"), info)


def number_targets(targets: DataFrame) -> DataFrame:
    """targets(taxon_id, cluster_id, chr, start, end, strand, seq) -> id TGT_00000 and on, description, seq."""
    rows = numbered(targets, ["taxon_id", "chr", "start", "end", "strand", "cluster_id"], "TGT_", 5)
    place = F.concat(F.col("chr"), F.lit(" ("), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(")"), F.col("strand"))
    return rows.select("id", F.concat_ws(" | ", "taxon_id", place, "cluster_id").alias("description"), "seq")


def write_targets(targets: DataFrame, path: str) -> None:
    write_fasta(number_targets(targets).orderBy("id"), path)


def summary(tiled: DataFrame, region_org: DataFrame, classes: DataFrame) -> DataFrame:
    """tiled(region_id, probes), region_org(region_id, org), classes(org, class) -> org, probes, class: what each organism gets, those with fewest first."""
    got = region_org.join(tiled.select("region_id", "probes"), "region_id").groupBy("org").agg(F.sum("probes").alias("probes"))
    return got.join(classes, "org", "left").orderBy("probes", "org")


def counts(regions: DataFrame, region: Column, taxon: Column) -> DataFrame:
    """One row: regions and distinct taxa that are left."""
    return regions.agg(F.count(region).alias("regions"), F.count_distinct(taxon).alias("taxa"))
