"""Intervals, runs and segments. Intervals are half-open [s, e) throughout."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.session import materialize


def merge_intervals(df: DataFrame, keys: list[str], s: str = "s", e: str = "e") -> DataFrame:
    """Unions of overlapping or touching intervals of each key: one sort within keys, no self-join."""
    order = W.partitionBy(*keys).orderBy(s, e)
    reach = F.max(e).over(order.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(reach >= F.col(s), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(s).alias(s), F.max(e).alias(e)).drop("_island")


def subtract_intervals(regions: DataFrame, cuts: DataFrame, keys: list[str], s: str = "s", e: str = "e", min_length: int = 1) -> DataFrame:
    """What is left of regions (one row per key) without the cuts, pieces of at least min_length, numbered from 0 by place.

    Cuts are clamped and merged; each leaves the gap to the next one, so a union and one window do it.
    """
    inside = cuts.select(*keys, F.col(s).alias("_cs"), F.col(e).alias("_ce")).join(regions, keys)
    clamped = inside.select(*keys, F.greatest(F.col("_cs"), F.col(s)).alias(s), F.least(F.col("_ce"), F.col(e)).alias(e)).where(F.col(s) < F.col(e))
    merged = merge_intervals(clamped, keys, s, e)
    edges = regions.select(*keys, F.col(s).alias("_s"), F.col(s).alias("_e")).unionByName(merged.select(*keys, F.col(s).alias("_s"), F.col(e).alias("_e")))
    ends = regions.select(*keys, F.col(e).alias("_end"))
    order = W.partitionBy(*keys).orderBy("_e", "_s")
    gaps = edges.join(ends, keys).withColumn("_next", F.coalesce(F.lead("_s").over(order), F.col("_end")))
    kept = gaps.where(F.col("_next") - F.col("_e") >= min_length)
    return kept.select(*keys, F.col("_e").alias(s), F.col("_next").alias(e), (F.row_number().over(W.partitionBy(*keys).orderBy("_e")) - 1).alias("piece"))


def _stretches(keys: list[str], pos: str):
    """Rows (keys, pos) -> keys, _s, _e: stretches of rows that follow each other with one key and rising places, half-open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = np.asarray(batch.column(len(keys)).cast(pa.int64()))
            same = np.diff(at) == 1
            for c in batch.columns[: len(keys)]:
                a, b = c.slice(0, n - 1), c.slice(1)
                equal = pc.fill_null(pc.equal(a, b), False)
                same &= np.asarray(pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b)))) if c.null_count else np.asarray(equal)
            starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
            ends = np.concatenate((starts[1:], [n])) - 1
            first = pa.array(starts, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(first) for c in batch.columns[: len(keys)]), pa.array(at[starts], pa.int64()), pa.array(at[ends] + 1, pa.int64())], [*keys, "_s", "_e"])

    return run


def collapse_runs(df: DataFrame, keys: list[str], pos: str = "pos", length: int = 1) -> DataFrame:
    """Windows of ``length`` at consecutive positions -> regions: first pos, len covered, n windows.

    Rows are drawn together to stretches where they are, so only these are dealt out and sorted; rows in any order give the same regions.
    """
    rows = df.select(*keys, pos).where(F.col(pos).isNotNull())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    found = rows.mapInArrow(_stretches(keys, pos), ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "_s long", "_e long"]))
    merged = merge_intervals(found, keys, "_s", "_e")
    n = F.col("_e") - F.col("_s")
    return merged.select(*keys, F.col("_s").cast(kinds[pos]).alias(pos), (n - 1 + length).cast(kinds[pos]).alias("len"), n.alias("n"))


def run_lengths(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Run-length encoding of value in each key: run (from 1), value, n."""
    w = W.partitionBy(*keys).orderBy(*order)
    turn = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    turns = df.withColumn("_turn", F.when(F.row_number().over(w) == 1, 1).otherwise(turn))
    return turns.withColumn("run", F.sum("_turn").over(w.rowsBetween(W.unboundedPreceding, 0))).groupBy(*keys, "run").agg(F.first(value).alias(value), F.count("*").alias("n"))


def longest_run(runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The longest run of each key, the first of equals."""
    return runs.groupBy(*keys).agg(F.max_by(F.struct(value, "n", "run"), F.struct("n", -F.col("run"))).alias("_b")).select(*keys, f"_b.{value}", "_b.n", "_b.run")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def ranged(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """df in ranges of a total order, written, with the number of each row's range as _part: running results within ranges are joined up over their ends, so a key may fill many tasks."""
    return materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)


def segment_offsets(segments: DataFrame, keys: list[str], order: list[str], length: Column, gap: int = 1) -> DataFrame:
    """Adds ord (from 1) and start: where each segment begins (0-based) when a key's segments are strung together with ``gap`` between them."""
    rows = ranged(segments.withColumn("_len", (length + gap).cast("long")), [*keys, *order], "segments")
    sums = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.sum("_len").alias("_sum"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per key and range
    none = F.lit(0).cast("long")
    ahead = sums.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), none).alias("_ord"), F.coalesce(F.sum("_sum").over(before), none).alias("_start"))
    w = W.partitionBy(*keys, "_part").orderBy(*order)
    own = rows.withColumns({"_i": F.row_number().over(w), "_at": F.coalesce(F.sum("_len").over(w.rowsBetween(W.unboundedPreceding, -1)), none)})
    j = own.join(ahead, _same(own, ahead, [*keys, "_part"]))
    return j.select(*(own[c] for c in segments.columns), (F.col("_ord") + F.col("_i")).cast("int").alias("ord"), (F.col("_start") + F.col("_at")).alias("start"))


def locate(points: DataFrame, segments: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """As-of lookup: each point's segment is the last that starts at or before it; local is its 0-based place there, null on a separator.

    A union of both sides in ranges of (key, place), instead of a range join; each range takes over the last segment of those before it. segments: start, segment, len.
    """
    begin = segments.select(*keys, F.col("start").alias(pos), F.lit(0).alias("_kind"), F.struct("segment", "start", "len").alias("_seg"))
    ask = points.select(*keys, pos, F.lit(1).alias("_kind"), F.lit(None).cast(begin.schema["_seg"].dataType).alias("_seg"))
    rows = ranged(begin.unionByName(ask), [*keys, pos, "_kind"], "places")
    ends = rows.groupBy(*keys, "_part").agg(F.max_by("_seg", F.when(F.col("_kind") == 0, F.col(pos))).alias("_seg"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per key and range
    carried = ends.select(*keys, "_part", F.last("_seg", True).over(before).alias("_carried"))
    w = W.partitionBy(*keys, "_part").orderBy(pos, "_kind").rowsBetween(W.unboundedPreceding, 0)
    own = rows.withColumn("_last", F.last("_seg", True).over(w)).where("_kind = 1")
    found = own.join(carried, _same(own, carried, [*keys, "_part"])).select(*(own[k] for k in keys), own[pos], F.coalesce("_last", "_carried").alias("_seg"))
    local = F.col(pos) - F.col("_seg.start")
    inside = local < F.col("_seg.len")
    return found.select(*keys, pos, F.when(inside, F.col("_seg.segment")).alias("segment"), F.when(inside, local).alias("local"))


#: Points that one row of a range stands for before it is spread, and those that a task then makes.
TILE, TASK = 1 << 14, 1 << 23


def locate_ranges(ranges: DataFrame, segments: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """locate for every place of ranges(keys, lo, hi), half-open, a few of each key: keys, pos, segment, local, null on a separator and before the first segment.

    A segment reaches to the next one's start, so what a range holds of it is an interval; these meet by key and are spread last. No row per place is dealt out or sorted.
    """
    order = W.partitionBy(*keys).orderBy("start")  # a row per segment, without its letters
    none = F.lit(None).cast("long")
    spans = segments.select(*keys, F.col("start").cast("long").alias("start"), F.lead(F.col("start").cast("long")).over(order).alias("_next"), "segment", F.col("len").cast("long").alias("len"))
    head = segments.groupBy(*keys).agg(F.min(F.col("start").cast("long")).alias("_next")).select(*keys, none.alias("start"), "_next", F.lit(None).cast(segments.schema["segment"].dataType).alias("segment"), none.alias("len"))
    spans = spans.unionByName(head)
    j = ranges.join(spans, _same(ranges, spans, keys), "left")
    lo, hi = F.greatest("lo", "start"), F.least("hi", "_next")  # nulls are left out
    cut = j.select(*(ranges[k] for k in keys), "start", "segment", "len", lo.cast("long").alias("_lo"), hi.cast("long").alias("_hi")).where("_lo < _hi")
    tiles = cut.withColumn("_at", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1, F.lit(TILE).cast("long"))))
    points = ranges.agg(F.sum(F.col("hi") - F.col("lo")).alias("n")).first().n or 0
    tiles = tiles.repartition(max(ranges.sparkSession.sparkContext.defaultParallelism, -(-points // TASK)))  # few bytes that stand for many rows
    each = tiles.withColumn(pos, F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + TILE, F.col("_hi")) - 1)))
    local = F.col(pos) - F.col("start")
    inside = local < F.col("len")
    return each.select(*keys, pos, F.when(inside, F.col("segment")).alias("segment"), F.when(inside, local).alias("local"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
