"""Vector code compression: product codes from a Lloyd iteration that is maintained by what changed.

Each component x becomes the whole number floor(scale * x); vectors are cut into equal consecutive parts, and each part
position has a codebook of its own. The state of a run is a table: each row's vector with its assignment of this round
and of the round before. A round is one pass over it: every part goes to its nearest entry, and a part whose assignment changed adds itself to the
new entry's sum and takes itself off the old one's. Tasks add these contributions up and leave them in an extra row of the table they write; only
those are shuffled, so rounds that change little move little. The driver keeps the running sums, as many numbers as the codebooks hold, and
replaces each entry by floor(sum / count). The table of the round before is deleted, so two are kept at most; a lost
executor repeats its tasks from the table it read.

All arithmetic is in whole numbers. Distances go through a matrix product of doubles where a bound on the components shows that every
intermediate number stays below 2**53, and through Python's whole numbers where it doesn't. Contributions travel in limbs of 32 bits, so sums
don't overflow either.

Defined results: rows whose vector is null, has no components or holds null or non-finite ones are dropped, as are those whose length
isn't that of most rows (ties: the longest). A length that the parts don't divide is filled up with zeros. The first entries are the parts of
the smallest ids, nulls last, equal ids by their vectors; fewer rows than entries make smaller codebooks, and equal
entries leave the later ones unused. Repeated rows count each; null ids are kept; an error beyond a long shows its limit. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.bit_slices import takes_part, whole
from tilewright.llm.common import ship
from tilewright.session import discard, materialize

#: Rows whose distances to a codebook are held at once.
CHUNK = 4096
LIMB = 32
LONGEST = (1 << 63) - 1
DELTA = "array<struct<part:int,entry:int,place:int,limb:int,value:bigint>>"
DELTA_ARROW = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))


@dataclass(frozen=True)
class Codes:
    """entries: of a codebook, 65,536 at most; scale: a power of 2, so that no product is rounded."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def quantise(vectors: pa.Array, c: Codes) -> np.ndarray:
    """Vectors of one length -> whole numbers (rows, parts, places): 64 bits, or Python's where they don't fit."""
    values = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)
    if values.size and np.abs(values).max() * c.scale >= 1 << 50:
        out = np.array([whole(x, c.scale) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)
    else:
        out = np.floor(values * c.scale).astype(np.int64)
    missing = -out.shape[1] % c.parts
    if missing:
        out = np.concatenate([out, np.zeros((len(out), missing), dtype=out.dtype)], axis=1)
    return out.reshape(len(out), c.parts, -1)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the least index of a nearest entry, and its squared distance."""
    most = max(_largest(rows), _largest(book))
    if 4 * rows.shape[1] * most * most < 1 << 53:
        own, entries = rows.astype(np.float64), book.astype(np.float64)
        far = own @ (-2 * entries.T) + (entries * entries).sum(axis=1)
        at = far.argmin(axis=1)
        return at, (far[np.arange(len(at)), at] + (own * own).sum(axis=1)).astype(np.int64)
    own, entries = rows.astype(object), book.astype(object)
    at, errors = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=object)
    for i, row in enumerate(own):
        far = ((entries - row) ** 2).sum(axis=1)
        at[i] = int(far.argmin())
        errors[i] = far[at[i]]
    return at, errors


def assign(rows: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (rows, parts) and the summed squared distances."""
    found = [nearest(rows[:, p], book) for p, book in enumerate(books)]
    return np.stack([at for at, _ in found], axis=1), sum(e for _, e in found)


class Sums:
    """Sums and counts of each entry of each part: place -1 holds the count."""

    def __init__(self, books: list[np.ndarray]):
        self.values = [np.zeros((len(b), b.shape[1] + 1), dtype=np.int64) for b in books]

    def add(self, part: int, entries: np.ndarray, rows: np.ndarray, sign: int) -> None:
        if not len(rows):
            return
        own = self.values[part]
        if own.dtype != object and (rows.dtype == object or _largest(rows) * len(rows) >= 1 << 50):
            own = self.values[part] = own.astype(object)  # a sum of 2**13 chunks at most stays below 2**63 else
        order = np.argsort(entries, kind="stable")
        held, starts = np.unique(entries[order], return_index=True)
        counted = np.concatenate([rows[order], np.ones((len(rows), 1), dtype=rows.dtype)], axis=1)
        own[held] += sign * np.add.reduceat(counted, starts, axis=0)

    def limbs(self) -> list[dict]:
        """What isn't 0, as limbs that add up each by itself."""
        out = []
        for part, own in enumerate(self.values):
            for entry, place in zip(*np.nonzero(own)):
                value, limb = int(own[entry, place]), 0
                while value:
                    piece = value if -(1 << LIMB) < value < 1 << LIMB else value & ((1 << LIMB) - 1)
                    out.append({"part": part, "entry": int(entry), "place": int(place) if place < own.shape[1] - 1 else -1, "limb": limb, "value": piece})
                    value, limb = (value - piece) >> LIMB, limb + 1
        return out


def _round(state: DataFrame, books: list[np.ndarray], c: Codes) -> DataFrame:
    """A round's table: every row with its assignment of before and of now, and a row per task with the contributions of the parts between which these differ."""
    kind = state.schema["vector"].dataType.simpleString()
    first = "now" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, added, schema = Sums(books), 0, None
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                some = batch.slice(i, CHUNK)
                rows = quantise(some.column(2), c)
                now, _ = assign(rows, books)
                was = None if first else np.frombuffer(b"".join(some.column(3).to_pylist()), dtype="<u2").reshape(now.shape).astype(np.int64)
                for p in range(c.parts):
                    changed = slice(None) if first else np.flatnonzero(was[:, p] != now[:, p])
                    sums.add(p, now[changed, p], rows[changed, p], 1)
                    if not first:
                        sums.add(p, was[changed, p], rows[changed, p], -1)
                codes = [x.tobytes() for x in now.astype("<u2")]
                columns = [*some.columns[:3], pa.array([None] * len(codes), pa.binary()) if first else some.column(3), pa.array(codes, pa.binary()), pa.nulls(len(codes), DELTA_ARROW)]
                out = pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "was", "now", "delta"])
                schema, added = out.schema, added + 1
                yield out
                if added % 8192 == 0:  # before a sum of 64 bits could run over
                    yield pa.RecordBatch.from_pylist([{"delta": sums.limbs()}], schema=schema)
                    sums = Sums(books)
        if schema is not None:
            yield pa.RecordBatch.from_pylist([{"delta": sums.limbs()}], schema=schema)

    columns = ["vec_id", "label", "vector", *([] if first else ["now"])]
    own = state if first else state.where("now is not null")
    label = state.schema["label"].dataType.simpleString()
    return own.select(columns).mapInArrow(run, f"vec_id long, label {label}, vector {kind}, was binary, now binary, delta {DELTA}")


def _updated(books: list[np.ndarray], sums: dict, state: DataFrame) -> list[np.ndarray]:
    """Entries after a round; ``sums`` (part, entry, place, limb) is brought up to date."""
    parts = state.where("delta is not null").select(F.inline("delta")).groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    for r in parts.collect():  # a number for each place of the codebooks and limb
        at = (r.part, r.entry, r.place)
        sums[at] = sums.get(at, 0) + (int(r.value) << (LIMB * r.limb))
    out = []
    for p, book in enumerate(books):
        rows = [[sums.get((p, e, i), 0) // n for i in range(book.shape[1])] if (n := sums.get((p, e, -1), 0)) else book[e].tolist() for e in range(len(book))]
        out.append(_whole_array(rows))
    return out


def _whole_array(rows: list[list[int]]) -> np.ndarray:
    large = any(abs(x) >= 1 << 62 for row in rows for x in row)
    return np.array(rows, dtype=object if large else np.int64)


def train(vectors: DataFrame, c: Codes = Codes()) -> tuple[DataFrame, list[np.ndarray]]:
    """vectors(vec_id, embedding, label) -> the last round's table and the final codebooks, one array (entries, places) per part; no codebooks if no row takes part."""
    ship(vectors.sparkSession)
    doubles = F.col("embedding").cast("array<double>")
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = vectors.where(takes_part(doubles)).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").alias("vector"))
    if dict(kept.dtypes)["vector"] not in ("array<float>", "array<double>"):
        kept = kept.withColumn("vector", F.col("vector").cast("array<double>"))
    state = materialize(kept, "vectors")
    lengths = state.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return state, []
    kept = state.where(F.size("vector") == lengths.n)
    kept._scratch = state._scratch
    state = kept
    least = state.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(c.entries).select("vector").collect()
    start = quantise(pa.array([r.vector for r in least], pa.list_(pa.float64())), c)
    books, sums = [_whole_array(start[:, p].tolist()) for p in range(c.parts)], {}
    for n in range(c.rounds):
        moved = materialize(_round(state, books, c), f"round-{n}")
        discard(state)
        state, books = moved, _updated(books, sums, moved)
    return state, books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for row in book for x in row).encode()).hexdigest()


def encode(state: DataFrame, books: list[np.ndarray], c: Codes = Codes()) -> DataFrame:
    """The table of train -> vec_id, label, code, error: assigned to the final codebooks."""
    width = 2 if c.entries <= 256 else 4
    label = state.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                some = batch.slice(i, CHUNK)
                at, errors = assign(quantise(some.column(2), c), books)
                codes = ["".join(f"{x:0{width}x}" for x in row) for row in at.tolist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(codes, pa.string()), pa.array([min(int(e), LONGEST) for e in errors], pa.int64())], ["vec_id", "label", "code", "error"])

    own = state.where("now is not null") if "now" in state.columns else state
    return own.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: list[np.ndarray], c: Codes = Codes()) -> DataFrame:
    """codes(vec_id, code) -> vec_id, vector: the entries that a code names, divided by the scale; null for a null code."""
    ship(codes.sparkSession)
    width = 2 if c.entries <= 256 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [None if code is None else [int(x) / c.scale for p, book in enumerate(books) for x in book[int(code[p * width : (p + 1) * width], 16)]] for code in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], ["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, vector array<double>")


def code_report(vectors: DataFrame, c: Codes = Codes()) -> DataFrame:
    """vectors(vec_id, embedding, label) -> vec_id, code, error, label_error, codebooks_sha256."""
    state, books = train(vectors, c)
    if not books:
        return state.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialize(encode(state, books, c), "codes")
    discard(state)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
