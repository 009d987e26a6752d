"""Command line: ``python -m tilewright --genomes list.tab --out folder`` runs all phases and writes their result files;
``python -m tilewright targets --clusters clusters.tsv --probes probes.tsv --genomes list.tab --out targets.fna`` cuts the genomes' regions that probes are meant for."""

from __future__ import annotations

import argparse
import logging
import sys
import typing
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tilewright.operators import targets
from tilewright.params import Params
from tilewright.plans.design import design, probe_summary
from tilewright.sources import fasta, gff, newick, outputs
from tilewright.sources.tables import PROBE_INFO, check_paths, parse_config, read_cluster_info, read_named, read_names, write_table


def parser() -> argparse.ArgumentParser:
    """An option for each parameter, with its default; what is given here goes before the configuration file."""
    out = argparse.ArgumentParser(prog="tilewright", description="Select node-specific, balanced probes from annotated genomes.")
    out.add_argument("--genomes", required=True, help="tab-separated list: GFF3 file, taxon id")
    out.add_argument("--out", required=True, help="folder for results")
    out.add_argument("--tree", help="Newick tree to assign clusters to; by default a consensus of their groupings")
    out.add_argument("--guide", help="Newick guide tree whose groupings count too")
    out.add_argument("--blacklists", default="", help="comma-separated FASTA files")
    out.add_argument("--config", help="tab-separated parameters")
    out.add_argument("--targets", default="", help="clusters whose regions go first, in order: comma-separated, or @file with a line each")
    out.add_argument("--summary", action="store_true", help="also write what each organism gets")
    out.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    out.add_argument("--force", action="store_true", help="run phases again that are finished")
    kinds = typing.get_type_hints(Params)
    for f in fields(Params):
        name, kind = "--" + f.name.replace("_", "-"), kinds[f.name]
        if kind is bool:
            out.add_argument(name, action=argparse.BooleanOptionalAction, default=None, help=f"default {f.default}")
        else:
            out.add_argument(name, type=kind if kind in (int, str) else float, default=None, help=f"default {f.default}")
    return out


def params(args: argparse.Namespace, config: str = "") -> Params:
    given = {f.name: getattr(args, f.name) for f in fields(Params) if getattr(args, f.name) is not None}
    return Params.from_pairs(parse_config(config) | {k: str(v) for k, v in given.items()})


def targets_parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tilewright targets", description="Cut the regions of genomes that probes are meant for.")
    out.add_argument("--clusters", required=True, help="members of clusters: the table that a design writes")
    out.add_argument("--probes", required=True, help="places of probes on clusters: the table that a design writes")
    out.add_argument("--genomes", required=True, help="tab-separated list: GFF3 file, taxon id")
    out.add_argument("--out", required=True, help="FASTA file to write")
    out.add_argument("--length", type=int, default=Params.length, help="of a probe, default %(default)s")
    out.add_argument("--flank", type=int, default=0, help="bases to add on both sides, default %(default)s")
    out.add_argument("--overlap", default="context", choices=["context", "probe", "none"], help="what is merged: regions with their flanks, probes only, or nothing")
    out.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    return out


def write_target_regions(spark: SparkSession, args: argparse.Namespace) -> None:
    """The targets command."""
    if args.length < 1 or args.flank < 0:
        raise ValueError("length must be 1 or more, flank 0 or more")
    info = read_named(spark, check_paths(spark, [args.probes])[0], PROBE_INFO).where("ClustPos is not null")
    members = read_cluster_info(spark, check_paths(spark, [args.clusters])[0], info)
    members = members.select(F.col("ClusterID").alias("cluster_id"), F.col("TaxonID").alias("taxon_id"), F.col("GeneID").alias("gene_id"), F.col("CIGAR").alias("cigar"))
    listed = [(r.path, r.taxon_id) for r in gff.read_genome_list(spark, args.genomes).collect()]  # a row per file
    check_paths(spark, [path for path, _ in listed])
    genes, contigs = gff.read_placed_genes(spark, listed, args.flank)
    probes = info.select(F.col("TaxonID").alias("taxon_id"), F.col("ClustID").alias("cluster_id"), F.col("ClustPos").alias("clust_pos"))
    joined = args.overlap == "context"
    found = targets.plan_targets(probes, members, genes, args.length, args.flank, "probe" if joined else args.overlap)
    if joined and args.flank:
        found = targets.joined_targets(found, contigs)
    outputs.write_targets(found, args.out)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["targets"]:
        args = targets_parser().parse_args(argv[1:])
        logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(message)s")
        return write_target_regions(SparkSession.builder.getOrCreate(), args)
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.getOrCreate()
    config = "".join(r.value for r in spark.read.text(check_paths(spark, [args.config]), wholetext=True).collect()) if args.config else ""
    p = params(args, config)
    listed = gff.read_genome_list(spark, args.genomes)
    genomes = [(r.path, r.taxon_id) for r in listed.collect()]  # a row per file
    check_paths(spark, [path for path, _ in genomes])
    genes = gff.read_genes(spark, genomes, p.name_pattern)
    tree, guide = (newick.read_newick(spark, x) if x else None for x in (args.tree, args.guide))
    out = design(spark, genes, p, tree, guide=guide, blacklists=fasta.read_blacklists(spark, args.blacklists), first=read_names(spark, args.targets), folder=f"{args.out}/phases", force=args.force)
    info = out["members"].join(genes.select("uid", "chr", "start", "end", "strand"), "uid")
    write = {
        "clusters.fna": lambda path: fasta.write_fasta(out["clusters"].select(F.col("cluster_id").alias("id"), "seq").orderBy("id"), path),
        "clusters.tsv": lambda path: outputs.write_cluster_info(info.select("cluster_id", "taxon_id", F.col("chr").alias("seq_id"), F.col("uid").alias("gene_id"), "start", "end", "strand", "cigar"), path),
        "assignment.tsv": lambda path: outputs.write_assignment(out["assignment"], path),
        "candidates.tab": lambda path: outputs.write_regions(out["candidates"], path),
        "filtered.tab": lambda path: outputs.write_regions(out["filtered"], path),
        "pseudo_genomes.fna": lambda path: outputs.write_pseudo_genomes(out["placed"].where("node_id <> '_LOWPEN_'"), path),
        "low_penetrance.fna": lambda path: outputs.write_low_penetrance(out["clusters"], out["assignment"], path),
        "nodes.newick": lambda path: newick.write_newick(out["nodes"], path),
    }
    if args.summary:
        write["summary.tsv"] = lambda path: write_table(probe_summary(out, p, p.with_genomes(genes.select("taxon_id").distinct().count()).probes), path)
    for name, write_to in write.items():
        write_to(f"{args.out}/{name}")
    outputs.write_probes(out["probes"], f"{args.out}/probes.fna", f"{args.out}/probes.tsv")


if __name__ == "__main__":
    main()
