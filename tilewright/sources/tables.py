"""Tab-separated tables with fixed schemas, and configuration text."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators.intervals import keep_first

log = logging.getLogger(__name__)

CLUSTER_INFO = "ClusterID string, TaxonID string, SeqID string, GeneID string, Start int, End int, Strand string, CIGAR string"
ASSIGNMENT = "ClusterID string, TaxonID string, Penetrance string"
REGIONS = "region_id string, node_id string, cluster_id string, pos int, len int, seq string"
PROBE_INFO = "ProbeID string, TaxonID string, ClustID string, ClustPos int"
LOW_COMPLEXITY = "region_id string, start int, end int"
HITS = "region_id string, length int, pident double, qstart int, qend int"


def check_header(found: list[str], required: list[str], optional: tuple[str, ...] = ()) -> None:
    missing, unknown = set(required) - set(found), set(found) - set(required) - set(optional)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    if unknown:
        log.warning("unknown columns: %s", ", ".join(sorted(unknown)))


def read_named(spark: SparkSession, path: str, schema: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """A table with a header, columns found by name in any order; optional ones may be absent and are null then."""
    want = [x.split() for x in schema.split(", ")]
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    check_header(raw.columns, [n for n, _ in want if n not in optional], optional)
    return raw.select(*(F.expr(f"try_cast(`{n}` as {k})").alias(n) if n in raw.columns else F.lit(None).cast(k).alias(n) for n, k in want))


def first_in_file(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key in the order of the files' lines. Rows are numbered where they are read."""
    return keep_first(df.withColumn("_line", F.monotonically_increasing_id()), [key], ["_line"]).drop("_line")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Candidate or filtered regions without a header; the first of equal ids wins."""
    return first_in_file(spark.read.option("sep", "\t").schema(REGIONS).csv(path), "region_id")


def read_cluster_info(spark: SparkSession, path: str, probed: DataFrame | None = None) -> DataFrame:
    """Cluster members; the CIGAR may be absent. probed(ClustID): only clusters that have probes."""
    rows = read_named(spark, path, CLUSTER_INFO, ("CIGAR",))
    return rows if probed is None else rows.join(probed.select(F.col("ClustID").alias("ClusterID")).distinct(), "ClusterID", "left_semi")


def read_paths(spark: SparkSession, path: str, must_exist: bool = True) -> list[str]:
    """The paths named in the lines of a file, each checked to be there."""
    return check_paths(spark, [r.value.strip() for r in spark.read.text(path).collect() if r.value.strip()], must_exist)


def check_paths(spark: SparkSession, paths: list[str], must_exist: bool = True) -> list[str]:
    for p in paths if must_exist else ():
        target = spark._jvm.org.apache.hadoop.fs.Path(p)
        if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            raise FileNotFoundError(p)
    return paths


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Low-complexity intervals, 0-based and inclusive, ids with or without > -> region_id, s, e: half-open, 1-based."""
    raw = spark.read.option("sep", "\t").schema(LOW_COMPLEXITY).csv(path)
    return raw.select(F.regexp_replace("region_id", "^>", "").alias("region_id"), (F.col("start") + 1).alias("s"), (F.col("end") + 2).alias("e"))


def read_hits(spark: SparkSession, path: str, length: int, identity: float) -> DataFrame:
    """Search hits, 1-based and inclusive, that are long and similar enough -> region_id, s, e: half-open."""
    raw = spark.read.option("sep", "\t").schema(HITS).csv(path).where((F.col("length") >= length) & (F.col("pident") >= identity))
    return raw.select("region_id", F.least("qstart", "qend").alias("s"), (F.greatest("qstart", "qend") + 1).alias("e"))


def write_table(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.option("sep", "\t").option("header", header).csv(path)


def numbered(df: DataFrame, order: list[str], prefix: str, digits: int, name: str = "id") -> DataFrame:
    """Adds ids prefix + number from 0 in a total order, zero-padded to ``digits`` (longer ones stay whole). The rows are sorted by range, so numbering needs no single task."""
    from pyspark.sql import Window as W

    ranged = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    from tilewright.session import materialize

    ranged = materialize(ranged, "numbered")
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_rows"))
    before = sizes.select("_p", (F.sum("_rows").over(W.orderBy("_p")) - F.col("_rows")).alias("_before"))  # a row per range
    own = F.row_number().over(W.partitionBy("_p").orderBy(*order)) - 1
    return ranged.withColumn("_own", own).join(before, "_p").withColumn(name, F.concat(F.lit(prefix), F.format_string(f"%0{digits}d", F.col("_before") + F.col("_own")))).drop("_p", "_own", "_before")


def parse_config(text: str) -> dict[str, str]:
    """key <tab> value lines; # lines, blank lines and lines of other than two fields are skipped; the last of equal keys wins."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        fields = line.rstrip("\r").split("\t")
        if line.strip() and not line.startswith("#") and len(fields) == 2:
            if fields[0] in out:
                log.warning("%s is set again", fields[0])
            out[fields[0]] = fields[1]
    return out


def read_names(spark: SparkSession, text: str, sep: str = ",") -> list[str]:
    """Names in a delimited string, or those in the lines of a file if it is named @path."""
    if not text.startswith("@"):
        return [x for x in text.split(sep) if x]
    return [r.value.strip() for r in spark.read.text(text[1:]).collect() if r.value.strip()]
