"""Connected components of link tables by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import ship
from tilewright.session import discard, materialize

#: Links that a task joins up at once before the stars; bounds its memory.
LOCAL = 200_000


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of a task, in bounded lots, as stars around the least node of each piece: the same components, fewer and shorter links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def stars() -> pa.RecordBatch:
        rows = [(x, find(x)) for x in list(parent)]
        parent.clear()
        rows = [(x, r) for x, r in rows if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > LOCAL:
            yield stars()
    yield stars()


def connected_components(links: DataFrame) -> DataFrame:
    """links(u, v) of longs -> node, root: the least node of its component, for every node that has a link to another.

    Each round hangs a node's larger neighbours, then its smaller ones, on the least; rounds grow with the logarithm of a
    component's size. Minima are partial aggregates, joins read written tables, so a hub's links spread over tasks. What is left at up to
    ``LOCAL`` / 2 links is joined up in one task, with the same result.
    """
    ship(links.sparkSession)
    e = links.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    first = materialize(e, "links")
    lots = max(1, -(-first.count() // LOCAL))  # tasks of many links each: a hub's nodes leave few of them
    e = materialize(first.coalesce(lots).mapInArrow(_local_stars, "u long, v long").distinct(), "stars")
    discard(first)

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    was = mark(e)
    while was[0] > LOCAL // 2:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = materialize(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        nearest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old = (e, least, large, nearest)
        e = materialize(small.unionByName(nearest.withColumnRenamed("m", "v")).distinct(), "stars")
        discard(*old)
        now = mark(e)
        if now == was:
            break
        was = now
    if was[0] <= LOCAL // 2:  # the stars of a single lot are the components
        e = materialize(e.coalesce(1).mapInArrow(_local_stars, "u long, v long"), "stars")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
