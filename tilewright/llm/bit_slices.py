"""Exact inner-product top-k through a bit-sliced index.

Each component x becomes floor(scale * x). A block of rows stores, for every dimension, its smallest value and one
bitmap per bit of what is above it. A query multiplies by shifting: its component is written in signed binary digits,
each non-zero digit adds the dimension's slices at a shift (complemented for a negative digit), and carry-save adders
over whole bitmaps sum them to the slices of all scores at once. The top rows are selected from the most
significant slice downward; rows still equal after the last slice have equal scores, and the boundary takes the smallest ids
among them. Scores are read off the summed slices. Nothing is approximate.

Components beyond 28 bits (any finite number may occur) are kept as Python's whole numbers, in blocks and chunks of their own: the
same slices, only more of them. Scores are ordered exactly whatever their size; ``score`` holds what a long can, and
its limit beyond.

The index is built in place, block by block, from the scan; queries are cut into chunks. Blocks are dealt to groups of
``HELD``, chunks to lanes, and each cell (group, lane) is a task that holds its group's blocks while the lane's chunks stream by. There
are no more lanes than chunks and no more than give each core two cells, so an index of many blocks is copied once and one of a
single block as often as cores need it. Every block returns its k best per query; a window limits these to k.

Defined results: rows with a null id, a null vector, null or non-finite components or no components take no part; vectors
meet only those of their own length. A repeated query id is one query, with the least of its vectors that take part; repeated candidates each
take a rank; rows with the query's own id are no candidates. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.common import ship
from tilewright.session import discard, materialize

BLOCK = 1 << 16
CHUNK = 64
#: Components from here on are Python's whole numbers: sums of products of smaller ones fit a long.
LARGE = 1 << 28
#: Blocks that a task holds, some MB each.
HELD = 8


def takes_part(vector: Column) -> Column:
    """Whether a vector of doubles has components, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole(x: float, scale: int) -> int:
    """floor(scale * x) of a finite double without rounding."""
    n, d = x.as_integer_ratio()
    return n * scale // d


def pack_whole(values: np.ndarray) -> bytes:
    """Whole numbers of any size: the bytes of each, then all in a row."""
    width = max([8, *((int(v).bit_length() + 8) // 8 for v in values.ravel())])
    return struct.pack("<I", width) + (values.astype("<i8").tobytes() if width == 8 else b"".join(int(v).to_bytes(width, "little", signed=True) for v in values.ravel()))


def unpack_whole(octets: bytes) -> np.ndarray:
    (width,) = struct.unpack_from("<I", octets)
    if width == 8:
        return np.frombuffer(octets, "<i8", offset=4)
    return np.array([int.from_bytes(octets[i : i + width], "little", signed=True) for i in range(4, len(octets), width)], dtype=object)


def order_key(score: int) -> bytes:
    """Bytes that compare as the whole numbers do."""
    n = (abs(score).bit_length() + 7) // 8
    octets = struct.pack(">H", n) + abs(score).to_bytes(n, "big")
    return b"\1" + octets if score >= 0 else b"\0" + bytes(255 - b for b in octets)


def quantise(ids: pa.Array, vectors: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of whole numbers) for each vector length, large components apart. All rows take part."""
    sizes = np.asarray(pc.list_value_length(vectors))
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        flat = np.asarray(vectors.take(pa.array(rows)).flatten().cast(pa.float64())).reshape(-1, n)
        own = np.asarray(ids.take(pa.array(rows))).astype(np.int64)
        with np.errstate(over="ignore"):
            values = np.floor(flat * scale)
        small = (np.abs(values) < LARGE).all(axis=1)
        if small.any():
            yield own[small], values[small].astype(np.int64)
        if not small.all():
            yield own[~small], np.array([[whole(x, scale) for x in row] for row in flat[~small].tolist()], dtype=object)


def _pack(rows: np.ndarray) -> np.ndarray:
    """A boolean matrix (rows, bitmaps) -> bitmaps of 64-bit words, one after another."""
    words = -(-len(rows) // 64)
    padded = np.zeros((words * 64, rows.shape[1]), dtype=np.uint8)
    padded[: len(rows)] = rows
    return np.packbits(padded, axis=0, bitorder="little").T.copy().view("<u8")


class Block:
    """Rows in ascending order of ids, as slices."""

    @staticmethod
    def build(ids: np.ndarray, values: np.ndarray) -> dict:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(axis=0)
        above = values - low
        bits = np.array([int(x).bit_length() for x in above.max(axis=0)], dtype="<u2")
        kind = above.dtype if above.dtype != object else object
        slices = [_pack((above[:, d, None] >> np.arange(bits[d], dtype=np.int64).astype(kind) & 1).astype(np.uint8)) for d in range(values.shape[1]) if bits[d]]
        return {"dim": values.shape[1], "ids": ids.astype("<i8").tobytes(), "low": pack_whole(low), "bits": bits.tobytes(), "slices": b"".join(x.tobytes() for x in slices)}

    def __init__(self, ids: bytes, low: bytes, bits: bytes, slices: bytes):
        self.ids, self.low, self.bits = np.frombuffer(ids, "<i8"), unpack_whole(low), np.frombuffer(bits, "<u2")
        self.words = -(-len(self.ids) // 64)
        self.slices = np.frombuffer(slices, "<u8").reshape(-1, self.words)
        self.first = np.cumsum(self.bits, dtype=np.int64) - self.bits
        self.rows = np.zeros(self.words, dtype="<u8")
        self.rows.view(np.uint8)[: -(-len(self.ids) // 8)] = np.packbits(np.ones(len(self.ids), dtype=np.uint8), bitorder="little")
        self.opposite = ~self.slices

    def scores(self, query: list[int]) -> tuple[list[np.ndarray], int]:
        """Slices of score - base for all rows, least significant first, and base."""
        columns: dict[int, list[np.ndarray]] = defaultdict(list)
        base = sum(q * low for q, low in zip(query, self.low.tolist()))
        for d, q in enumerate(query):
            n, at = int(self.bits[d]), int(self.first[d])
            for shift, sign in signed_digits(q) if n else ():
                source = self.slices if sign > 0 else self.opposite
                for b in range(n):
                    columns[shift + b].append(source[at + b])
                if sign < 0:
                    base -= (1 << shift) * ((1 << n) - 1)
        out, p = [], 0
        while p <= max(columns, default=-1):
            column = columns[p]
            while len(column) > 2:  # full adder: three bitmaps of one weight -> a sum and a carry
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                column.insert(0, half ^ c)
                half &= c
                a = a & b
                a |= half
                columns[p + 1].append(a)
            if len(column) == 2:
                a, b = column
                columns[p + 1].append(a & b)
                column[:] = [a ^ b]
            out.append(column[0] if column else np.zeros(self.words, dtype="<u8"))
            p += 1
        return out, base

    def top(self, query: list[int], own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows without those of id own; ties to smaller ids."""
        slices, base = self.scores(query)
        tied = self.rows.copy()
        if own is not None:
            for i in range(*np.searchsorted(self.ids, (own, own + 1)).tolist()):
                tied[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        sure, n_sure = np.zeros(self.words, dtype="<u8"), 0
        for s in reversed(slices):
            ones = tied & s
            n = int(np.bitwise_count(ones).sum())
            if n_sure + n > k:
                tied = ones
            else:
                sure, n_sure = sure | ones, n_sure + n
                tied = tied & ~s
                if n_sure == k:
                    break
        picked = _positions(sure)
        if n_sure < k:
            picked = np.concatenate((picked, _positions(tied)[: k - n_sure]))
        kind = np.int64 if len(slices) < 62 and abs(base) < 1 << 62 else object
        scores = np.full(len(picked), base, dtype=kind)
        word, bit = picked >> 6, (picked & 63).astype(np.uint64)
        for p, s in enumerate(slices):
            scores += (s[word] >> bit & np.uint64(1)).astype(np.int64).astype(kind) << p
        return self.ids[picked], scores


def _positions(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return words[row] * 64 + bit


def signed_digits(q: int) -> list[tuple[int, int]]:
    """q as a sum of sign * 2**shift without neighbouring digits: the fewest there can be."""
    out, shift = [], 0
    while q:
        if q & 1:
            sign = 2 - (q & 3)
            out.append((shift, sign))
            q -= sign
        q >>= 1
        shift += 1
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vectors(vec_id, embedding) -> the rows that take part, as long and array<double>."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding")))


INDEX = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("low", pa.binary()), ("bits", pa.binary()), ("slices", pa.binary())])
CHUNKS = pa.schema([("dim", pa.int32()), ("q_ids", pa.binary()), ("queries", pa.binary())])


def build_index(vectors: DataFrame, scale: int = 64, block: int = BLOCK) -> DataFrame:
    """vectors(vec_id, embedding) -> blocks of up to ``block`` rows."""
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

        def emit(n: tuple[int, bool]) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(n)))
            return pa.RecordBatch.from_pylist([Block.build(ids, values)], schema=INDEX)

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                for ids, values in quantise(some.column(0), some.column(1), scale):
                    n = values.shape[1], values.dtype == object
                    if held[n] and sum(len(i) for i, _ in held[n]) + len(ids) > block:
                        yield emit(n)
                    held[n].append((ids, values))
        for n in [n for n, x in held.items() if x]:
            yield emit(n)

    tasks = max(1, vectors.count() // (block // 2))
    return usable(vectors).coalesce(tasks).mapInArrow(run, "dim int, ids binary, low binary, bits binary, slices binary")


def query_chunks(vectors: DataFrame, scale: int) -> DataFrame:
    """vectors(vec_id, embedding) -> chunks of up to CHUNK queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in quantise(batch.column(0), batch.column(1), scale):
                for at in range(0, len(ids), CHUNK):
                    row = {"dim": values.shape[1], "q_ids": ids[at : at + CHUNK].astype("<i8").tobytes(), "queries": pack_whole(values[at : at + CHUNK])}
                    yield pa.RecordBatch.from_pylist([row], schema=CHUNKS)

    rows = usable(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.mapInArrow(run, "dim int, q_ids binary, queries binary")


def _turn(parts: int) -> Column:
    """A part for each number of monotonically_increasing_id: the task that made the row plus the row's place there, in turn."""
    return F.pmod(F.shiftright("number", 33) + F.col("number").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(parts)).cast("int")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, block: int = BLOCK, held: int = HELD, cells: int | None = None) -> DataFrame:
    """vectors(vec_id, embedding) -> query_id, rank, vec_id, score: the k best of all rows for each row that is_query holds for. cells: tasks to aim at, by default two a core."""
    spark = vectors.sparkSession
    number = F.monotonically_increasing_id().alias("number")
    index = materialize(build_index(vectors, scale, block).select("*", number), "bit-slices", "none")
    chunks = materialize(query_chunks(vectors.where(is_query), scale).select("*", number), "queries", "none")
    cells = cells or 2 * spark.sparkContext.defaultParallelism
    n_blocks, n_chunks = max(1, index.count()), max(1, chunks.count())
    n_groups = max(-(-n_blocks // held), min(n_blocks, cells))
    n_lanes = max(1, min(n_chunks, cells // n_groups))
    none = F.lit(None).cast("binary")
    blocks = index.select(_turn(n_groups).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1))).alias("lane"), "dim", "ids", "low", "bits", "slices", none.alias("q_ids"), none.alias("queries"))
    asked = chunks.select(F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"), _turn(n_lanes).alias("lane"), "dim", *(none.alias(c) for c in ("ids", "low", "bits", "slices")), "q_ids", "queries")
    cell = (F.col("group") * n_lanes + F.col("lane")).cast("int")
    met = blocks.unionByName(asked).withColumn("cell", cell).repartitionById(n_groups * n_lanes, F.col("cell")).sortWithinPartitions("cell", F.col("ids").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple[int, Block]] = []  # a partition is a cell: its blocks come before its chunks
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, low, bits, slices, q_ids, queries = (batch.column(c)[i].as_py() for c in range(7))
                if ids is not None:
                    own.append((dim, Block(ids, low, bits, slices)))
                    continue
                asked = np.frombuffer(q_ids, "<i8")
                for query, q in zip(asked.tolist(), unpack_whole(queries).reshape(len(asked), -1).tolist()):
                    for n, part in own:
                        if n == dim:
                            found, scores = part.top(q, query, k)
                            exact = [int(x) for x in scores]
                            near = [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in exact]
                            yield pa.RecordBatch.from_arrays([pa.array([query] * len(found), pa.int64()), pa.array(found, pa.int64()), pa.array(near, pa.int64()), pa.array(map(order_key, exact), pa.binary())], ["query_id", "vec_id", "score", "place"])

    with batch_rows(spark, 8):  # a row holds a block, some MB
        rows = met.select("dim", "ids", "low", "bits", "slices", "q_ids", "queries").mapInArrow(run, "query_id long, vec_id long, score long, place binary")
        best = materialize(rows, "best")
    discard(index, chunks)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("place"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside; the session's setting is put back."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
