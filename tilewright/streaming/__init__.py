"""Micro-batch screening of arriving sequences.

The operators of this library work on whole tables; what needs a row alone also works on a stream. There are no windows in
time, no state and no late data here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import seq as S
from tilewright.params import Params

SEQUENCES = "id string, seq string"


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """A stream of tab-separated files (id, seq) as they appear in a folder."""
    return spark.readStream.schema(SEQUENCES).option("sep", "\t").csv(path)


def screen(seqs: DataFrame, p: Params = Params()) -> DataFrame:
    """seqs(id, seq) -> id, pos, window, gc of windows within the GC limits; the same on a table and on a stream."""
    low, high = p.gc_bounds
    windows = S.explode_windows(seqs, p.length)
    return windows.withColumn("gc", S.gc_count(F.col("window"))).where((F.col("gc") >= low) & (F.col("gc") < high))


def screen_stream(spark: SparkSession, source: str, target: str, checkpoint: str, p: Params = Params()):
    """Starts the query: every file once, results as Parquet, committed through the checkpoint."""
    return screen(read_sequences(spark, source), p).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
