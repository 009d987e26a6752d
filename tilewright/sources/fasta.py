"""FASTA: records are split by the reader itself, so large files are read in parallel; gzip by extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.seq import wrap


def read_fasta(spark: SparkSession, path: str | list[str], column: str = "path") -> DataFrame:
    """-> path, id, description, seq (upper case as it is in the file)."""
    raw = spark.read.option("lineSep", "\n>").text(path).withColumn(column, F.col("_metadata.file_path"))
    record = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    body = F.when(F.instr("_r", "\n") > 0, F.expr("substring(_r, instr(_r, '\\n') + 1)")).otherwise("")
    rows = raw.select(column, record.alias("_r")).where(F.trim("_r") != "").select(column, F.substring_index("_r", "\n", 1).alias("_h"), body.alias("_b"))
    return rows.select(column, F.regexp_extract("_h", r"^(\S*)", 1).alias("id"), F.trim(F.regexp_extract("_h", r"^\S*\s*(.*)$", 1)).alias("description"), F.regexp_replace("_b", r"\s", "").alias("seq"))


def read_cluster_sequences(spark: SparkSession, path: str, assigned: DataFrame | None = None) -> DataFrame:
    """-> cluster_id, seq; the first of equal ids wins. assigned(cluster_id): only these."""
    from tilewright.sources.tables import first_in_file

    rows = first_in_file(read_fasta(spark, path), "id").select(F.col("id").alias("cluster_id"), "seq")
    return rows if assigned is None else rows.join(assigned.select("cluster_id").distinct(), "cluster_id", "left_semi")


def read_alignment(spark: SparkSession, path: str) -> DataFrame:
    """An aligner's FASTA -> path, uid, aligned in upper case; raises if the rows of a file differ in length."""
    rows = read_fasta(spark, path).select("path", F.col("id").alias("uid"), F.upper(F.translate("seq", ".", "-")).alias("aligned"))
    odd = rows.groupBy("path").agg(F.min(F.length("aligned")).alias("a"), F.max(F.length("aligned")).alias("b")).where("a <> b").first()
    if odd:
        raise ValueError(f"rows of different lengths in {odd.path}")
    return rows


def read_blacklists(spark: SparkSession, paths: str) -> list[DataFrame]:
    """Comma-separated FASTA files -> (id, seq) of each, one table a file; a missing file is named at once."""
    from tilewright.sources.tables import check_paths

    return [read_fasta(spark, p).select("id", F.upper("seq").alias("seq")) for p in check_paths(spark, [p.strip() for p in paths.split(",") if p.strip()])]


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """df(id, seq, description if there is one): one record per row, sequences wrapped."""
    head = F.concat(F.lit(">"), "id", F.when(F.col("description") != "", F.concat(F.lit(" "), "description")).otherwise("")) if "description" in df.columns else F.concat(F.lit(">"), "id")
    df.select(F.concat(head, F.lit("\n"), wrap(F.col("seq"), width)).alias("value")).write.text(path)
