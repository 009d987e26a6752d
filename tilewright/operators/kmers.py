"""K-mers as packed longs, and window sums, one NumPy pass per sequence: no row per base is shuffled and no string per window is made."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.seq import BASES
from tilewright.session import materialize

#: Rows of one output batch.
ROWS = 1 << 18
CODES = np.full(256, 4, dtype=np.int64)
CODES[[ord(b) for b in BASES]] = range(4)


def codes(text: str) -> np.ndarray:
    """0 to 3 for ACGT, 4 for anything else."""
    return CODES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of about ``limit`` bytes of a string column, a row at least: bounds what a pass holds at once."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                yield batch.slice(i, j - i)


def pack(base: np.ndarray, k: int, canonical: bool) -> tuple[np.ndarray, np.ndarray]:
    """(0-based starts, packed k-mers, first base highest) of windows of ACGT only; canonical: the smaller of both strands."""
    n = len(base) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    forward, back = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for j in range(k):
        part = base[j : j + n]
        forward = forward << 2 | part & 3
        back |= (3 - (part & 3)) << 2 * j
    bad = np.concatenate(([0], np.cumsum(base == 4)))
    good = np.flatnonzero(bad[k:] == bad[:-k])
    return good, (np.minimum(forward, back) if canonical else forward)[good]


def packed_kmers(df: DataFrame, k: int, canonical: bool = True, seq: str = "seq") -> DataFrame:
    """df(..., seq) -> ..., pos (1-based), kmer (long): every k-mer of up to 31 bases."""
    if k > 31:
        raise ValueError("a long holds 31 bases")
    keep = [c for c in df.columns if c != seq]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, np.ndarray, np.ndarray]] = []
            held = 0

            def emit() -> pa.RecordBatch:
                at = pa.array(np.repeat([i for i, _, _ in rows], [len(p) for _, p, _ in rows]))
                out = [*(batch.column(c).take(at) for c in range(1, batch.num_columns)), pa.array(np.concatenate([p for _, p, _ in rows]) + 1, pa.int32()), pa.array(np.concatenate([x for _, _, x in rows]), pa.int64())]
                return pa.RecordBatch.from_arrays(out, [*keep, "pos", "kmer"])

            for i, text in enumerate(batch.column(0).to_pylist()):
                starts, kmers = pack(codes(text or ""), k, canonical)
                for a in range(0, len(starts), ROWS):
                    rows.append((i, starts[a : a + ROWS], kmers[a : a + ROWS]))
                    held += len(rows[-1][1])
                    if held >= ROWS:
                        yield emit()
                        rows.clear()
                        held = 0
            if rows:
                yield emit()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), "pos int", "kmer long"])
    return df.select(seq, *keep).mapInArrow(run, schema)


#: Bases whose k-mers a task sorts at once, and those that a bucket takes.
PIECE, BUCKET = 1 << 21, 1 << 22


def _pieces(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (seq, label) -> k-mers and their labels, up to about PIECE at a time; long sequences in overlapping stretches."""
    held, size = [], 0
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            base = codes(text or "")
            for at in range(0, max(len(base) - k + 1, 0), PIECE):
                kmers = pack(base[at : at + PIECE + k - 1], k, True)[1]
                held.append((kmers, np.full(len(kmers), label, dtype=np.int64)))
                size += len(kmers)
                if size >= PIECE:
                    yield tuple(np.concatenate(x) for x in zip(*held))
                    held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _least_and_most(kmers: np.ndarray, least: np.ndarray, most: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct k-mers in order, with the least and greatest label and the sum of the counts of each."""
    order = np.argsort(kmers, kind="stable")
    kmers = kmers[order]
    starts = np.flatnonzero(np.concatenate(([True], kmers[1:] != kmers[:-1]))) if len(kmers) else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return kmers, least, most, n
    return kmers[starts], np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts), np.add.reduceat(n[order], starts)


#: An odd factor: products modulo a power of two are a mix that can be undone.
ODD = 0x9E3779B97F4A7C15


def mixed(kmers: np.ndarray, k: int) -> np.ndarray:
    """Packed k-mers, spread over the same 2k bits."""
    return (kmers.astype(np.uint64) * np.uint64(ODD)) & np.uint64((1 << 2 * k) - 1)


def unmixed(values: np.ndarray, k: int) -> np.ndarray:
    return ((values.astype(np.uint64) * np.uint64(pow(ODD, -1, 1 << 64))) & np.uint64((1 << 2 * k) - 1)).astype(np.int64)


def bucket_cuts(values: np.ndarray, k: int, buckets: int) -> np.ndarray:
    """Where the buckets, equal ranges of 2k bits, begin among sorted values, and their end."""
    return np.searchsorted(values, np.array([-(-(i << 2 * k) // buckets) for i in range(buckets)] + [1 << 2 * k], dtype=np.uint64))


def _planes(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as the greatest needs, the lowest bytes of all first: high ones are mostly 0 and all but vanish when Spark compresses them."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return np.uint32(len(values)).tobytes() + bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _of_planes(blob: bytes) -> np.ndarray:
    n, width = int(np.frombuffer(blob, "<u4", 1)[0]), blob[4]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8, offset=5).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def squeeze(values: np.ndarray) -> bytes:
    """Rising numbers (one at least) as the first and the distances."""
    return values[:1].astype("<u8").tobytes() + _planes(np.diff(values))


def unsqueeze(blob: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate((np.frombuffer(blob, "<u8", 1), _of_planes(blob[8:]))), dtype=np.uint64)


def _labels(values: np.ndarray) -> bytes:
    """Labels, also negative ones, as the least and what each has more."""
    least = values.min()
    return np.int64(least).tobytes() + _planes(values - least)


def _of_labels(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i8", 1)[0] + _of_planes(blob[8:]).astype(np.int64)


def kmer_summary(seqs: DataFrame, k: int, several: str) -> DataFrame:
    """seqs(seq, label long) -> kmer (canonical), least, most (of the labels), n (occurrences) of every k-mer with several labels (``several`` = "labels") or occurrences ("n").

    K-mers travel as the distances of sorted arrays, two or three bytes each: a task reduces its own to distinct ones and deals them to buckets by a mix of their bits, and a bucket's arrays
    are reduced again. A hot k-mer is an entry per piece. There are as many buckets as the bases need, so each fits a task.
    """
    spark = seqs.sparkSession
    bases = seqs.agg(F.sum(F.length("seq")).alias("n")).first().n or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bases // BUCKET))
    names = ["kmer", "least", "most", "n"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kmers, labels in _pieces(batches, k):
            values, least, most, n = _least_and_most(mixed(kmers, k), labels, labels, np.ones(len(kmers), dtype=np.int64))
            cuts = bucket_cuts(values, k, buckets)
            used = np.flatnonzero(np.diff(cuts))
            blobs = [pa.array([pack_(c[cuts[i] : cuts[i + 1]]) for i in used], pa.binary()) for c, pack_ in ((values, squeeze), (least, _labels), (most - least, _planes), (n, _planes))]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *blobs], ["bucket", *names])

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for value, least, wider, n in zip(*(c.to_pylist() for c in batch.columns)):
                low = _of_labels(least)
                held.append((unsqueeze(value), low, low + _of_planes(wider).astype(np.int64), _of_planes(n).astype(np.int64)))
            if sum(len(x[0]) for x in held) > 2 * BUCKET:
                held = [_least_and_most(*(np.concatenate(x) for x in zip(*held)))]
        if held:
            columns = _least_and_most(*(np.concatenate(x) for x in zip(*held)))
            pick = columns[1] < columns[2] if several == "labels" else columns[3] > 1
            columns = [c[pick] for c in columns]
            columns[0] = unmixed(columns[0], k)
            for at in range(0, len(columns[0]), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS], pa.int64()) for c in columns], names)

    dealt = seqs.select("seq", "label").mapInArrow(deal, "bucket int, kmer binary, least binary, most binary, n binary")
    return dealt.repartitionById(buckets, F.col("bucket")).select(*names).mapInArrow(reduce_, "kmer long, least long, most long, n long")


#: Bases of the pieces that one task takes.
TASK = 1 << 25


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, id, label) with a piece: rows of one label, about PIECE bases, a row at least."""
    own, made, now = TaskContext.get().partitionId() << 32, 0, {}
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(0)), 0))
        found = []
        for size, label in zip(sizes.tolist(), batch.column(2).to_pylist()):
            piece, held = now.get(label, (0, PIECE))
            if held >= PIECE:
                piece, held, made = own + made, 0, made + 1
            now[label] = piece, held + size
            found.append(piece)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["seq", "id", "label", "piece"])


def unshared_runs(seqs: DataFrame, k: int, length: int, first: int, bases: int) -> DataFrame:
    """seqs(id, label, seq) of so many bases -> id, s, e: half-open runs of window starts (1-based, from ``first``) that hold no k-mer of another label.

    Sequences are put together to pieces of one label. A piece's distinct k-mers travel to buckets as distances of sorted arrays, a bucket sees which of them several labels have, and
    a bit for each comes back to the piece, which knows their order: k-mers with their places are never rows.
    """
    spark = seqs.sparkSession
    kind = seqs.schema["id"].dataType.simpleString()
    tasks, buckets = max(spark.sparkContext.defaultParallelism, -(-bases // TASK)), max(spark.sparkContext.defaultParallelism, -(-bases // BUCKET))
    rows = materialize(seqs.select("seq", "id", "label").mapInArrow(_numbered, f"seq string, id {kind}, label long, piece long"), "pieces")
    rows = rows.repartition(tasks, "piece")

    def packed(texts: list[str | None]) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
        """Each sequence's length, starts and mixed k-mers, and the piece's distinct ones in order."""
        each = []
        for text in texts:
            starts, found = pack(codes(text or ""), k, True)
            each.append((len(text or ""), starts, mixed(found, k)))
        return each, np.unique(np.concatenate([np.zeros(0, np.uint64), *(found for *_, found in each)]))

    def deal(table: pa.Table) -> pa.Table:
        values = packed(table.column("seq").to_pylist())[1]
        cuts = bucket_cuts(values, k, buckets)
        used = np.flatnonzero(np.diff(cuts))
        piece, label = (np.full(len(used), table.column(c)[0].as_py()) for c in ("piece", "label"))
        blobs = pa.array([squeeze(values[cuts[i] : cuts[i + 1]]) for i in used], pa.binary())
        return pa.table([pa.array(piece, pa.int64()), pa.array(label, pa.int64()), pa.array(used, pa.int32()), blobs], ["piece", "label", "bucket", "kmers"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]  # of one bucket
        if not held:
            return
        apart = [unsqueeze(blob) for *_, blob in held]
        values, at = np.unique(np.concatenate(apart), return_inverse=True)
        label = np.repeat([label for _, label, _, _ in held], [len(x) for x in apart])
        least, most = np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), np.iinfo(np.int64).min)
        np.minimum.at(least, at, label)
        np.maximum.at(most, at, label)
        shared, ends = (least < most)[at], np.cumsum([len(x) for x in apart])
        for i in range(0, len(held), 1 << 12):
            own = range(i, min(i + (1 << 12), len(held)))
            bits = [np.packbits(shared[ends[j] - len(apart[j]) : ends[j]]).tobytes() for j in own]
            yield pa.RecordBatch.from_arrays([pa.array([held[j][0] for j in own], pa.int64()), pa.array([held[j][2] for j in own], pa.int32()), pa.array([len(apart[j]) for j in own], pa.int32()), pa.array(bits, pa.binary())], ["piece", "bucket", "n", "bits"])

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        each, values = packed(left.column("seq").to_pylist())
        shared = np.zeros(0, dtype=np.uint64)
        if right.num_rows:
            back = right.sort_by("bucket")
            bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for n, b in zip(back.column("n").to_pylist(), back.column("bits").to_pylist())]
            shared = values[np.concatenate(bits).astype(bool)]
        own, s, e = [], [], []
        for i, (size, starts, found) in enumerate(each):
            if size < length + first - 1:
                continue
            bad = np.zeros(size - k + 2, dtype=np.int64)
            if len(shared):
                at = np.minimum(np.searchsorted(shared, found), len(shared) - 1)
                bad[starts[shared[at] == found] + 1] = 1
            bad = np.cumsum(bad)
            free = bad[length - k + 1 :] == bad[: size - length + 1]
            free[: first - 1] = False
            edges = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
            own += [i] * (len(edges) // 2)
            s += (edges[::2] + 1).tolist()
            e += (edges[1::2] + 1).tolist()
        return pa.table([left.column("id").take(pa.array(own, pa.int64())), pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["id", "s", "e"])

    dealt = rows.groupBy("piece").applyInArrow(deal, "piece long, label long, bucket int, kmers binary")
    marked = dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(mark, "piece long, bucket int, n int, bits binary").repartition(tasks, "piece")
    return rows.groupBy("piece").cogroup(marked.groupBy("piece")).applyInArrow(runs, f"id {kind}, s int, e int")


def spans_of(seqs: DataFrame, kmers: np.ndarray, k: int, length: int) -> DataFrame:
    """seqs(id, seq) -> id, s, e: merged, half-open runs of window starts (1-based, not clamped) whose windows of ``length`` hold one of the sorted k-mers."""
    shared = seqs.sparkSession.sparkContext.broadcast(kmers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            own, s, e = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                starts, found = pack(codes(text or ""), k, True)
                if not len(wanted) or not len(found):
                    continue
                at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                on = starts[wanted[at] == found] + 1
                if len(on):
                    turns = np.flatnonzero(np.diff(on) > length - k + 1)
                    firsts, lasts = on[np.concatenate(([0], turns + 1))], on[np.concatenate((turns, [len(on) - 1]))]
                    own += [i] * len(firsts)
                    s += (firsts - (length - k)).tolist()
                    e += (lasts + 1).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["id", "s", "e"])

    return seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, s int, e int")


def row_batches(of: pa.Array, found: Iterator[tuple[int, list[np.ndarray]]], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """(row of ``of``, columns of what it gives) -> batches of about ROWS rows, long results in stretches."""
    held: list[tuple[int, list[np.ndarray]]] = []
    size = 0

    def emit() -> pa.RecordBatch:
        at = np.repeat([i for i, _ in held], [len(c[0]) for _, c in held])
        return pa.RecordBatch.from_arrays([of.take(pa.array(at, pa.int64())), *(pa.array(np.concatenate(x), kind) for x, kind in zip(zip(*(c for _, c in held)), kinds))], names)

    for i, columns in found:
        for at in range(0, len(columns[0]), ROWS):
            held.append((i, [c[at : at + ROWS] for c in columns]))
            size += len(held[-1][1][0])
            if size >= ROWS:
                yield emit()
                held, size = [], 0
    if held:
        yield emit()


def _gc(text: str, length: int, first: int) -> np.ndarray:
    """Letters other than A and T in each window of ``length`` from ``first`` on."""
    base = codes(text)
    total = np.concatenate(([0], np.cumsum((base != 0) & (base != 3))))
    return (total[length:] - total[:-length])[first - 1 :] if len(base) >= length else total[:0]


def gc_windows(seqs: DataFrame, length: int, low: int, high: int, first: int = 1) -> DataFrame:
    """seqs(id, seq of ACGT) -> id, pos, gc: a row for each window with low <= G and C < high."""

    def found(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
        for i, text in enumerate(texts):
            gc = _gc(text or "", length, first)
            ok = np.flatnonzero((gc >= low) & (gc < high))
            yield i, [ok + first, gc[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            yield from row_batches(batch.column(0), found(batch.column(1).to_pylist()), ["id", "pos", "gc"], [pa.int32(), pa.int32()])

    return seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, pos int, gc int")


def gc_summary(seqs: DataFrame, length: int, low: int, high: int, first: int = 1) -> DataFrame:
    """seqs(id, seq of ACGT) -> id, windows (with low <= G and C < high), least, most (of their G and C), counted in place: no row per window. Ids without such windows go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            own, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                gc = _gc(text or "", length, first)
                gc = gc[(gc >= low) & (gc < high)]
                if len(gc):
                    own.append(i)
                    rows.append((len(gc), int(gc.min()), int(gc.max())))
            n, least, most = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(n, pa.int64()), pa.array(least, pa.int32()), pa.array(most, pa.int32())], ["id", "windows", "least", "most"])

    each = seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, windows long, least int, most int")
    return each.groupBy("id").agg(F.sum("windows").alias("windows"), F.min("least").alias("least"), F.max("most").alias("most"))


def letter_gaps(seqs: DataFrame, letter: str) -> DataFrame:
    """seqs(id, seq) -> id, pos (0-based), before, after: every place and its distances to the nearest ``letter`` at or before and at or after it, -1 where there is none. Nothing is shuffled."""

    def found(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
        for i, text in enumerate(texts):
            on = np.frombuffer((text or "").encode("ascii", "replace"), np.uint8) == ord(letter)
            at, far = np.arange(len(on)), len(on)
            last = np.maximum.accumulate(np.where(on, at, -1))
            next_ = np.minimum.accumulate(np.where(on, at, far)[::-1])[::-1]
            yield i, [at, np.where(last < 0, -1, at - last), np.where(next_ == far, -1, next_ - at)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            yield from row_batches(batch.column(0), found(batch.column(1).to_pylist()), ["id", "pos", "before", "after"], [pa.int64()] * 3)

    return seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, pos long, before long, after long")


def gc_runs(seqs: DataFrame, length: int, low: int, high: int, first: int = 1, with_seq: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """seqs(id, seq of ACGT) -> id, pos, len, n: runs of consecutive windows with low <= G and C < high, found in place; with_seq adds the bases of each. Columns ``keep`` of seqs go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            own, pos, n, cut = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                base = codes(text or "")
                total = np.concatenate(([0], np.cumsum((base == 1) | (base == 2))))
                gc = total[length:] - total[:-length] if len(base) >= length else total[:0]
                ok = np.concatenate(([False], (gc >= low) & (gc < high), [False]))
                ok[1:first] = False
                edges = np.flatnonzero(ok[1:] != ok[:-1])
                own += [i] * (len(edges) // 2)
                pos += (edges[::2] + 1).tolist()
                n += (edges[1::2] - edges[::2]).tolist()
                if with_seq:
                    cut += [text[a : b + length - 1] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
            lengths = np.array(n, dtype=np.int64) + (length - 1)
            at = pa.array(own, pa.int64())
            out = [batch.column(0).take(at), pa.array(pos, pa.int32()), pa.array(lengths, pa.int32()), pa.array(n, pa.int64()), *([pa.array(cut, pa.string())] if with_seq else []), *(c.take(at) for c in batch.columns[2:])]
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", "pos", "len", "n", *(["seq"] if with_seq else []), *keep]
    kinds = {f.name: f.dataType.simpleString() for f in seqs.schema}
    return seqs.select("id", "seq", *keep).mapInArrow(run, f"id {kinds['id']}, pos int, len int, n long" + ", seq string" * with_seq + "".join(f", `{c}` {kinds[c]}" for c in keep))
