"""Token files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

Ids are replaced by their frequency rank over all documents, so common ones need a single byte. A rank takes 1 to 4
bytes, lowest first; four 2-bit lengths share a control byte, and each document begins a new one. A block holds
documents in a row:

    magic "TWF1" | docs u4 | control bytes u8 | data bytes u8 | doc_id i8[] | null flag u1[] | ids u8[] | control | data

Blocks are rows of Parquet files in the shared folder, committed by Spark's writer, in ascending doc_id (null first):
column ``part`` numbers the ranges, ``block`` the blocks of a range. The id of each rank stands beside them (``blocks`` and
``ranks`` below the folder), so the folder alone is enough to read them, in any session. Decoding looks the lengths of four ids up in a
256-row table and gathers all bytes of a block at once.

Flow: tokenise once and keep the ids in the shared folder, with each task's counts of ids; add the counts up (a row per id, at most the
vocabulary, goes to the driver for the rank table); range-partition by doc_id, length, a hash of the ids and the row, so that equal and null ids
spread over ranges; code, and write blocks of at most ``BLOCK_IDS`` ids or one
document. Every stage streams; no stage holds more than a batch and a block.

Defined results: null and empty texts have only the end id; an empty table gives empty files and result; rows with the
same doc_id follow each other in an order fixed by their ids; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.byte_bpe import encoder
from tilewright.llm.common import groups, ship, spans
from tilewright.session import discard, materialize, scratch

MAGIC = b"TWF1"
HEAD = struct.Struct("<4sIQQ")
BLOCK_IDS = 1 << 21
#: Bytes of each of the four ids of a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


@dataclass(frozen=True)
class TokenFiles:
    """A folder with ``blocks`` (part, block, n_docs, n_ids, bytes) and ``ranks`` (rank, id)."""

    path: str

    def ids(self, spark: SparkSession) -> np.ndarray:
        """The id of each rank, at most the vocabulary."""
        rows = spark.read.schema("rank int, id long").parquet(f"{self.path}/ranks").collect()
        out = np.zeros(len(rows), dtype=np.uint32)
        out[[r["rank"] for r in rows]] = [r["id"] for r in rows]
        return out


def _used(counts: np.ndarray) -> np.ndarray:
    """Which of the 2-bit lengths belong to ids: a document's last control byte may have up to three to spare."""
    ends = np.cumsum(-(-counts // 4)) * 4
    spare = -counts % 4
    used = np.ones(int(ends[-1]) if len(ends) else 0, dtype=bool)
    for k in range(1, 4):
        used[ends[spare >= k] - k] = False
    return used


def code(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of documents with ``counts`` ranks each, in a row."""
    length = (ranks > 0xFF).astype(np.uint8)
    for least in (0xFFFF, 0xFFFFFF):
        if ranks.max(initial=0) > least:
            length += ranks > least
    used = _used(counts)
    slots = np.zeros(len(used), dtype=np.uint8)
    slots[used] = length
    four = slots.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    width = int(length.max(initial=0)) + 1
    octets = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    return control.tobytes(), octets[np.arange(width, dtype=np.uint8) <= length[:, None]].tobytes()


def decode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of documents with ``counts`` each, in a row."""
    lengths = LENGTHS[control].reshape(-1)[_used(counts)]
    start = np.cumsum(lengths, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    start -= lengths
    out = data[start].astype(np.uint32)
    for j in range(1, int(lengths.max(initial=1))):
        more = np.flatnonzero(lengths > j)
        out[more] |= data[start[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def write_block(doc_ids: list[int | None], counts: np.ndarray, control: bytes, data: bytes) -> bytes:
    null = np.array([x is None for x in doc_ids], dtype=np.uint8)
    ids = np.array([x or 0 for x in doc_ids], dtype="<i8")
    return b"".join((HEAD.pack(MAGIC, len(ids), len(control), len(data)), ids.tobytes(), null.tobytes(), counts.astype("<u8").tobytes(), control, data))


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, ids per document, ranks in a row."""
    magic, docs, n_control, n_data = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEAD.size
    ids = np.frombuffer(block, "<i8", docs, at)
    null = np.frombuffer(block, np.uint8, docs, at := at + 8 * docs)
    counts = np.frombuffer(block, "<u8", docs, at := at + docs).astype(np.int64)
    control = np.frombuffer(block, np.uint8, n_control, at := at + 8 * docs)
    data = np.frombuffer(block, np.uint8, n_data, at + n_control)
    return [None if n else i for i, n in zip(ids.tolist(), null.tolist())], counts, decode(control, data, counts)


def tokenize(docs: DataFrame, path: str, end_id: int | None = 0) -> DataFrame:
    """documents(doc_id, text) -> doc_id, n_tokens, ids, counts.

    ids: in the fewest bytes an id of the vocabulary needs (2 or 4), little-endian, zstd. A last row of each task has -1 tokens and, in
    counts, how often the task met each id (int64, zstd).
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        bpe, pack = encoder(path), zstandard.ZstdCompressor(level=1).compress
        kind, total = id_type(bpe.size), np.zeros(bpe.size, dtype="<i8")
        names = ["doc_id", "n_tokens", "ids", "counts"]
        for batch in groups(batches, "text"):
            ids, counts = bpe.encode(batch.column(1))
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            total += np.bincount(ids, minlength=bpe.size)
            octets = memoryview(ids.astype(kind).tobytes())
            packed = [pack(octets[a:b]) for a, b in zip(*spans(counts * kind.itemsize))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.nulls(len(packed), pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([-1], pa.int64()), pa.nulls(1, pa.binary()), pa.array([pack(total.tobytes())], pa.binary())], names)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids binary, counts binary")


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def id_counts(tokens: DataFrame, vocabulary: int) -> DataFrame:
    """tokens of tokenize -> id, n: the counts of all tasks, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, total = zstandard.ZstdDecompressor().decompress, np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.frombuffer(unpack(packed.as_py()), "<i8")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return tokens.where("n_tokens < 0").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, end_id: int | None = 0) -> TokenFiles:
    """Tokenise all of documents(doc_id, text) and write the files."""
    spark = docs.sparkSession
    vocabulary = encoder(path).size
    tokens = materialize(tokenize(docs, path, end_id).select("*", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("row")), "tokens", "none")
    counted = id_counts(tokens, vocabulary).orderBy(F.desc("n"), "id").select("id").collect()  # at most the vocabulary
    by_rank = np.array([r.id for r in counted], dtype=np.uint32)
    rank_of = np.zeros(vocabulary, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # 4 bytes for each id of the vocabulary
    out = scratch(spark, "token-files")
    spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank int, id long").coalesce(1).write.parquet(f"{out}/ranks")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        unpack, kind, part, number, held = zstandard.ZstdDecompressor().decompress, id_type(vocabulary), TaskContext.get().partitionId(), 0, 0
        doc_ids, sizes, held_ids = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            counts = np.array(sizes, dtype=np.int64)
            control, data = code(shared.value[np.frombuffer(b"".join(held_ids), kind)], counts)
            row = {"part": [part], "block": [number], "n_docs": [len(doc_ids)], "n_ids": [held], "bytes": [write_block(doc_ids, counts, control, data)]}
            number, held = number + 1, 0
            for x in (doc_ids, sizes, held_ids):
                x.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("bytes", pa.binary())]))

        for batch in groups(batches, "ids", 2 << 20):
            for doc_id, n, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if doc_ids and held + n > BLOCK_IDS:
                    yield flush()
                doc_ids.append(doc_id), sizes.append(n), held_ids.append(unpack(packed))
                held += n
        if doc_ids:
            yield flush()

    order = ["doc_id", "n_tokens", "tie", "row"]
    ordered = tokens.where("n_tokens >= 0").select("doc_id", "n_tokens", "ids", "tie", "row").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(blocks, "part int, block long, n_docs long, n_ids long, bytes binary").write.option("compression", "none").parquet(f"{out}/blocks")
    discard(tokens)
    return TokenFiles(out)


def read_token_files(files: TokenFiles, spark: SparkSession) -> DataFrame:
    """-> doc_id, start (ids of all documents before it), n_tokens, ids_crc32, all from the files."""
    rows = spark.read.schema("part int, block long, n_docs long, n_ids long, bytes binary").parquet(f"{files.path}/blocks")
    by_rank = spark.sparkContext.broadcast(files.ids(spark))  # 4 bytes for each id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids, counts, ranks = read_block(content)
                octets = by_rank.value[ranks].astype("<u4").tobytes()
                first = np.cumsum(counts) - counts
                crc = [zlib.crc32(octets[4 * a : 4 * b]) for a, b in zip(*spans(counts))]
                arrays = [pa.array([part] * len(ids), pa.int32()), pa.array([block] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "block", "doc_id", "own", "n_tokens", "ids_crc32"])

    decoded = rows.select("part", "block", "bytes").mapInArrow(run, "part int, block long, doc_id long, own long, n_tokens long, ids_crc32 long")
    sizes = rows.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("part_start"))  # a row per range
    within = F.sum("n_ids").over(W.partitionBy("part").orderBy("block")) - F.col("n_ids")
    starts = sizes.withColumn("within", within).join(parts, "part").select("part", "block", (F.col("part_start") + F.col("within")).alias("block_start"))
    return decoded.join(starts, ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")
