"""Exact token counts for every context limit from a histogram of encoded lengths.

Documents are encoded whole and aggregated by length; what any limit costs follows from suffix sums over the
lengths that occur: the documents and ids of at least a length give the totals, the quantiles and, with the
documents cut off at a limit, the truncated totals. The sums run in two levels, within bins of ``BIN`` lengths and
over the bins, so no task sorts more than the lengths of a bin or the bins.

Defined results: null and empty texts have length 0 and are counted; an empty table gives an empty histogram; repeated
rows count each time; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.byte_bpe import encoder
from tilewright.llm.common import groups, ship
from tilewright.session import materialize

BIN = 1024


def encoded_lengths(docs: DataFrame, path: str) -> DataFrame:
    """documents(text) -> n_tokens, a row per document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in groups(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(bpe.encode(batch.column(0))[1], pa.int64())], ["n_tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """lengths(n_tokens) -> a row per length that occurs: n_tokens, docs, docs_from (of this length or longer), ids_from (their ids), truncated (all ids if documents are cut to this length), share_below (of documents that are shorter)."""
    hist = lengths.groupBy("n_tokens").agg(F.count("*").alias("docs")).withColumn("bin", F.floor(F.col("n_tokens") / BIN))
    hist = materialize(hist, "histogram")  # read twice; the encoding isn't to run twice
    bins = hist.groupBy("bin").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("n_tokens")).alias("i"))
    after = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    none = F.lit(0).cast("long")
    bins = bins.select("bin", F.coalesce(F.sum("d").over(after), none).alias("d_after"), F.coalesce(F.sum("i").over(after), none).alias("i_after"), F.sum("d").over(whole).alias("all_docs"), F.sum("i").over(whole).alias("all_ids"))
    down = W.partitionBy("bin").orderBy(F.desc("n_tokens"))
    out = hist.join(bins, "bin").withColumns({
        "docs_from": F.col("d_after") + F.sum("docs").over(down),
        "ids_from": F.col("i_after") + F.sum(F.col("docs") * F.col("n_tokens")).over(down),
    })
    return out.select(
        "n_tokens", "docs", "docs_from", "ids_from",
        (F.col("all_ids") - F.col("ids_from") + F.col("docs_from") * F.col("n_tokens")).alias("truncated"),
        ((F.col("all_docs") - F.col("docs_from")) / F.col("all_docs")).alias("share_below"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Truncated totals of any context limits, from the histogram: limit_, docs_cut, ids_kept, ids_lost."""
    cols = [F.struct(
        F.lit(n).cast("long").alias("context"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > n, F.col("docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.least("n_tokens", F.lit(n)) * F.col("docs")), F.lit(0)).alias("ids_kept"),
        F.coalesce(F.sum(F.greatest(F.col("n_tokens") - n, F.lit(0)) * F.col("docs")), F.lit(0)).alias("ids_lost"),
    ) for n in limits]
    return histogram.agg(F.array(*cols).alias("rows")).select(F.inline("rows"))
