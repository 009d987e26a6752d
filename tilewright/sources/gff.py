"""GFF3 with embedded FASTA: genes with their sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.functions.seq import revcomp


def read_genome_list(spark: SparkSession, path: str | None, files: tuple[str, ...] = ()) -> DataFrame:
    """Files named directly, then rows of a list (path, taxon id if given) -> path, taxon_id. A missing id is the file's base name; the first of equal ids wins."""
    rows = spark.createDataFrame([(i, p, None) for i, p in enumerate(files)], "ord long, path string, taxon_id string")
    if path:
        text = spark.read.text(path).select(F.monotonically_increasing_id().alias("_i"), F.regexp_replace("value", "\r", "").alias("v")).where(F.trim("v") != "")
        cut = F.split("v", "\t")
        rows = rows.unionByName(text.select((F.col("_i") + len(files)).alias("ord"), cut[0].alias("path"), F.nullif(F.try_element_at(cut, F.lit(2)), F.lit("")).alias("taxon_id")))
    base = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"(\.gff)?(\.gz)?$", "")
    rows = rows.withColumn("taxon_id", F.coalesce("taxon_id", base))
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("taxon_id").orderBy("ord"))).where("_n = 1").select("path", "taxon_id")


def read_gff(spark: SparkSession, paths: list[str]) -> DataFrame:
    """-> path, part (0 features, 1 FASTA), at (line number), value."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split(F.regexp_replace("value", "\r", ""), "##FASTA", 2).alias("parts"))
    return whole.select("path", F.posexplode("parts").alias("part", "text"))


def features(gff: DataFrame, kind: str = "CDS") -> DataFrame:
    """read_gff rows, perhaps with taxon_id -> path, at, chr, start, end, strand, attributes (, taxon_id) of features of one kind. Lines that begin with ## or #! are skipped."""
    more = ["taxon_id"] if "taxon_id" in gff.columns else []
    lines = gff.where("part = 0").select("path", *more, F.posexplode(F.split("text", "\n")).alias("at", "line")).where(~F.col("line").startswith("##") & ~F.col("line").startswith("#!"))
    f = F.split("line", "\t")
    wide = lines.where(F.size(f) >= 9).select("path", *more, "at", *(f[i].alias(f"f{i}") for i in (0, 2, 3, 4, 6, 8)))
    attributes = F.expr("map_from_entries(transform(filter(split(f8, ';'), x -> contains(x, '=')), x -> struct(trim(split(x, '=', 2)[0]), split(x, '=', 2)[1])))")
    return wide.where(F.col("f2") == kind).select("path", "at", F.col("f0").alias("chr"), F.expr("try_cast(f3 as int)").alias("start"), F.expr("try_cast(f4 as int)").alias("end"), F.col("f6").alias("strand"), attributes.alias("attributes"), *more)


def contigs(gff: DataFrame) -> DataFrame:
    """read_gff rows -> path, chr, seq of the embedded FASTA."""
    records = gff.where("part = 1").select("path", F.explode(F.split("text", "(^|\n)>")).alias("r")).where(F.trim(F.regexp_replace("r", "\n", "")) != "")
    return records.select("path", F.regexp_extract("r", r"^(\S+)", 1).alias("chr"), F.upper(F.regexp_replace(F.regexp_replace("r", r"^[^\n]*", ""), r"\s", "")).alias("seq"))


def genes(gff: DataFrame, pattern: str = ".+") -> DataFrame:
    """read_gff rows with taxon_id -> taxon_id, path, chr, family, uid (ID.taxon.number), gene_id, start, end, strand, seq (reverse complement on -).

    The family is the first match of pattern in the Name, else the whole Name, else UNKNOWN; numbers follow the file.
    """
    from tilewright.operators.cluster import family_name

    found = features(gff).withColumn("name", F.try_element_at("attributes", F.lit("Name"))).withColumn("family", family_name("name", pattern))
    number = F.row_number().over(W.partitionBy("taxon_id").orderBy("at"))
    gene = F.coalesce(F.try_element_at("attributes", F.lit("ID")), F.lit("UNKNOWN"))
    named = found.withColumns({"gene_id": gene, "uid": F.concat_ws(".", gene, "taxon_id", number.cast("string"))})
    cut = F.substring(F.col("seq"), F.col("start"), F.col("end") - F.col("start") + 1)
    return named.join(contigs(gff), ["path", "chr"]).select("taxon_id", "path", "chr", "family", "uid", "gene_id", "start", "end", "strand", F.when(F.col("strand") == "-", revcomp(cut)).otherwise(cut).alias("seq"))


def _of_taxa(spark: SparkSession, genomes: list[tuple[str, str]]) -> DataFrame:
    """genomes (path, taxon_id) -> read_gff rows with taxon_id."""
    base = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    ids = spark.createDataFrame(genomes, "_p string, taxon_id string")
    return read_gff(spark, [p for p, _ in genomes]).join(F.broadcast(ids), base(F.col("path")) == base(F.col("_p"))).drop("_p")  # a row per file that the caller named


def read_genes(spark: SparkSession, genomes: list[tuple[str, str]], pattern: str = ".+") -> DataFrame:
    """genomes (path, taxon_id) -> genes of the files."""
    return genes(_of_taxa(spark, genomes), pattern)


def read_placed_genes(spark: SparkSession, genomes: list[tuple[str, str]], flank: int) -> tuple[DataFrame, DataFrame]:
    """genomes (path, taxon_id) -> all genes with flanks as genes_with_flanks gives them, named as read_genes does (uid), and the contigs."""
    from tilewright.operators.targets import genes_with_flanks

    rows = _of_taxa(spark, genomes)
    notes = genes(rows).select(F.col("uid").alias("gene_id"), "path", "chr", "start", "end", "strand")
    return genes_with_flanks(notes, contigs(rows), flank), contigs(rows)


def read_known_genes(spark: SparkSession, paths: list[str], known: DataFrame, flank: int) -> DataFrame:
    """The genes of known(gene_id) in GFF files, with flanks clamped to their contigs, as genes_with_flanks gives them."""
    from tilewright.operators.targets import genes_with_flanks

    gff = read_gff(spark, paths)
    notes = features(gff).withColumn("gene_id", F.try_element_at("attributes", F.lit("ID"))).join(known.select("gene_id").distinct(), "gene_id", "left_semi")
    return genes_with_flanks(notes.select("gene_id", "path", "chr", "start", "end", "strand"), contigs(gff), flank)
