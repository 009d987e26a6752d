"""Similar stretches: seeds, ungapped identity along diagonals, low complexity, hairpins and dimers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions import seq as S
from tilewright.operators.intervals import merge_intervals
from tilewright.operators.kmers import ROWS, codes, pieces, row_batches


def seed_hits(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """a, b(id, seq) -> a_id, b_id, diagonal (pos in a - pos in b), strand, seeds: shared k-mers, a row per diagonal.

    b is the query set; its reverse complement is searched too. Hits on a diagonal are added up before anything is verified.
    """
    return spaced_hits(a.select("id", "seq"), b.select("id", "seq"), ["1" * k])


#: Found by search_seeds(8, 11, 28): of simulated windows of 75 with 57 equal bases 99.99% agree under one of them somewhere, and all of those whose differences mostly fall on every third base.
SEEDS = [
    "11101100001001101101",
    "101101000100101100111",
    "1010011000101010011011",
    "10111001011011011",
    "1100101001101000100000001011",
    "10111000000110000101001011",
    "1111010001001000010101001",
    "1011101001000000000101000111",
]


def simulated_windows(rng: np.random.Generator, n: int, length: int, equal: int) -> np.ndarray:
    """n windows with exactly ``equal`` equal bases: in every other one differences fall eight times as often on every third base, as those of coding sequences do."""
    same = np.ones((n, length), dtype=bool)
    for i, row in enumerate(same):
        weight = np.ones(length)
        if i % 2:
            weight[i // 2 % 3 :: 3] = 8
        row[rng.choice(length, length - equal, replace=False, p=weight / weight.sum())] = False
    return same


def seed_hit(same: np.ndarray, seed: str) -> np.ndarray:
    """Whether each window agrees under the seed at any place."""
    n = same.shape[1] - len(seed) + 1
    return np.logical_and.reduce([same[:, p : p + n] for p, c in enumerate(seed) if c == "1"]).any(axis=1)


def search_seeds(number: int, weight: int, longest: int, length: int = 75, equal: int = 57, windows: int = 6000, tries: int = 300, seed: int = 1) -> list[str]:
    """Greedy: of ``tries`` random patterns always the one that hits the most windows, those hit before counting a quarter for each time."""
    rng = np.random.default_rng(seed)
    same, worth, found = simulated_windows(rng, windows, length, equal), np.ones(windows), []
    for _ in range(number):
        best: tuple = (-1.0, "", None)
        for _ in range(tries):
            span = int(rng.integers(weight + 2, longest + 1))
            ones = {0, span - 1, *(1 + rng.choice(span - 2, weight - 2, replace=False)).tolist()}
            pattern = "".join("1" if i in ones else "0" for i in range(span))
            hit = seed_hit(same, pattern)
            if worth[hit].sum() > best[0]:
                best = (worth[hit].sum(), pattern, hit)
        found.append(best[1])
        worth[best[2]] /= 4
    return found


#: Equal keys at places of one distance, from so many on, travel as a run: repeats in tandem don't meet place by place.
TANDEM = 8


def tandem_runs(key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys at rising places -> key, first place, distance, number: runs of TANDEM or more, and single places (distance 0)."""
    order = np.argsort(key, kind="stable")
    key, pos = key[order], pos[order]
    if not len(key):
        return key, pos, pos, pos
    gap = np.where(key[1:] == key[:-1], np.diff(pos), 0)
    # stretches of one gap within a key; the first place of a stretch belongs to the one before
    starts = np.flatnonzero(np.concatenate(([True], gap[1:] != gap[:-1]))) if len(gap) else np.zeros(0, np.int64)
    lengths = np.diff(np.concatenate((starts, [len(gap)])))
    taken = np.zeros(len(key), dtype=bool)
    rows = []
    for at, n in zip(starts.tolist(), lengths.tolist()):
        if not gap[at] or n + 1 < TANDEM:
            continue
        first = at + 1 if taken[at] else at
        number = at + n - first + 1
        if number >= TANDEM:
            taken[first : at + n + 1] = True
            rows.append((first, gap[at], number))
    single = np.flatnonzero(~taken)
    many = np.array(rows, dtype=np.int64).reshape(-1, 3)
    at = np.concatenate((single, many[:, 0]))
    return key[at], pos[at], np.concatenate((np.zeros(len(single), np.int64), many[:, 1])), np.concatenate((np.ones(len(single), np.int64), many[:, 2]))


#: Keys of the smaller side that may be sent to all tasks.
SENT = 1 << 22


def _powers(base: np.ndarray, widest: int) -> dict[int, np.ndarray]:
    """Two bits a base -> width: the bases from each place on as one number, for widths of 1, 2, 4 up to the widest."""
    out, width = {1: base}, 1
    while 2 * width <= widest:
        one = out[width]
        out[2 * width] = one[: max(len(one) - width, 0)] << 2 * width | one[width:]
        width *= 2
    return out


def _steps(ones: list[int]) -> list[tuple[int, int]]:
    """A seed's places -> stretches (place, width) of one width each, powers of two."""
    out, i = [], 0
    while i < len(ones):
        n = next((k for k in range(1, len(ones) - i) if ones[i + k] != ones[i] + k), len(ones) - i)
        width = 1 << n.bit_length() - 1
        out.append((ones[i], width))
        i += width
    return out


class _Wanted:
    """Tells which keys are among some: most others fall out by a table of the keys' upper bits after mixing, the rest by search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.shift = keys, np.uint64(64 - min(max(len(keys).bit_length() + 4, 16), 26))
        self.table = np.zeros(1 << 64 - int(self.shift), dtype=bool)
        self.table[self._slot(keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def places(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.table[self._slot(keys)])
        return at[self.keys[np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)] == keys[at]]


def _keyed(df: DataFrame, seeds: list[str], seq: str, runs: bool, wanted: np.ndarray | None = None) -> DataFrame:
    """wanted: only rows of these keys, sorted ones."""
    keep = [c for c in df.columns if c != seq]
    ones = [[i for i, c in enumerate(seed) if c == "1"] for seed in seeds]
    if max(map(len, ones)) > 28:
        raise ValueError("a key holds 28 bases")
    more = ["pos", "key", "step", "n"] if runs else ["pos", "key"]
    steps = [_steps(places) for places in ones]
    widest = max(width for own in steps for _, width in own)
    sent = None if wanted is None else df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = None if sent is None else _Wanted(sent.value)
        for batch in batches:
            rows: list[np.ndarray] = []
            held: list[tuple[np.ndarray, ...]] = []
            size = 0

            def emit() -> pa.RecordBatch:
                at, columns = pa.array(np.concatenate(rows)), [np.concatenate(x) for x in zip(*held)]
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32()]
                return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(1, batch.num_columns)), *(pa.array(x, kind) for x, kind in zip(columns, kinds))], [*keep, *more])

            for i, text in enumerate(batch.column(0).to_pylist()):
                base = codes(text or "")
                bad, powers = base > 3, _powers(base & 3, widest)
                whole = not bad.any()
                for number, (places, own) in enumerate(zip(ones, steps)):
                    n = len(base) - places[-1]
                    if n <= 0:
                        continue
                    key = np.zeros(n, dtype=np.int64)
                    for at, width in own:
                        key = key << 2 * width | powers[width][at : at + n]
                    key |= number << 56
                    pos = np.arange(n) if few is None else few.places(key)
                    if not whole:
                        pos = pos[~np.logical_or.reduce([bad[pos + at] for at in places])]
                    if not len(pos):
                        continue
                    found = (pos, key[pos])
                    if runs:
                        key, pos, step, count = tandem_runs(*found[::-1])
                        found = (pos, key, step, count)
                    rows.append(np.full(len(pos), i))
                    held.append((found[0] + 1, *found[1:]))
                    size += len(pos)
                    if size >= ROWS:
                        yield emit()
                        rows, held, size = [], [], 0
            if held:
                yield emit()

    kinds = {"key": "long"}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), *(f"{c} {kinds.get(c, 'int')}" for c in more)])
    return df.select(seq, *keep).mapInArrow(run, schema)


def spaced_keys(df: DataFrame, seeds: list[str] = SEEDS, seq: str = "seq") -> DataFrame:
    """df(..., seq) -> ..., pos (1-based), key: the bases under the ones of each seed, two bits each, with the seed's number above them. Windows of ACGT only."""
    return _keyed(df, seeds, seq, False)


def spaced_runs(df: DataFrame, seeds: list[str] = SEEDS, seq: str = "seq", wanted: np.ndarray | None = None) -> DataFrame:
    """spaced_keys with repeats in tandem drawn together: pos, key, step, n stand for n places, ``step`` apart, from pos on. wanted: only these keys, sorted ones."""
    return _keyed(df, seeds, seq, True, wanted)


def both_strands(seqs: DataFrame) -> DataFrame:
    """seqs(id, seq, ...) -> the same with strand: each sequence and its reverse complement."""
    strands = F.array(F.struct(F.lit("+").alias("strand"), F.col("seq").alias("seq")), F.struct(F.lit("-").alias("strand"), S.revcomp(F.col("seq")).alias("seq")))
    return seqs.withColumn("_x", F.explode(strands)).select(*(c for c in seqs.columns if c != "seq"), "_x.strand", "_x.seq")


def spaced_hits(a: DataFrame, b: DataFrame, seeds: list[str] = SEEDS) -> DataFrame:
    """a, b(id, seq), perhaps with node_id -> a_id, b_id, diagonal, strand, seeds: places where both agree under a seed, on either strand of b, a row per diagonal. With nodes, only pairs of different ones.

    If b has few keys (SENT at most), they go to the sequences of a, whose other places never become rows. Repeats in tandem meet as runs: two runs of m and n places of one distance have m * n pairs of places on m + n - 1 diagonals, and only these are made, with their numbers of pairs.
    """
    nodes = "node_id" in a.columns and "node_id" in b.columns
    more = ["node_id"] if nodes else []
    keys = spaced_runs(both_strands(b.select("id", *more, "seq")), seeds)
    bases = b.agg(F.sum(F.length("seq")).alias("n")).first().n or 0
    wanted = np.unique(keys.select("key").distinct().toPandas()["key"].to_numpy(np.int64)) if 2 * bases * len(seeds) <= SENT else None
    own = spaced_runs(a.select("id", *more, "seq"), seeds, wanted=wanted).withColumnsRenamed({"id": "a_id", "pos": "a_pos", "node_id": "a_node", "step": "a_step", "n": "a_n"})
    query = keys.withColumnsRenamed({"id": "b_id", "pos": "b_pos", "node_id": "b_node", "step": "b_step", "n": "b_n"})
    met = own.join(query, "key")
    if nodes:
        met = met.where("a_node <> b_node")
    # runs of unlike distances: the places of b's one by one
    unlike = (F.col("a_n") > 1) & (F.col("b_n") > 1) & (F.col("a_step") != F.col("b_step"))
    places = F.explode(F.sequence(F.lit(0), F.when(unlike, F.col("b_n") - 1).otherwise(0))).alias("_i")
    met = met.select("*", places).withColumns({"b_pos": F.col("b_pos") + F.when(unlike, F.col("_i") * F.col("b_step")).otherwise(0), "b_n": F.when(unlike, 1).otherwise(F.col("b_n"))})
    step = F.greatest("a_step", F.when(F.col("b_n") > 1, F.col("b_step")).otherwise(0))
    apart = met.select("a_id", "b_id", "strand", "a_n", "b_n", (F.col("a_pos") - F.col("b_pos")).alias("_d"), step.alias("_s"), F.explode(F.sequence(1 - F.col("b_n"), F.col("a_n") - 1)).alias("_t"))
    pairs = F.least(F.col("a_n") - 1, F.col("b_n") - 1 + F.col("_t")) - F.greatest(F.lit(0), F.col("_t")) + 1
    return apart.groupBy("a_id", "b_id", "strand", (F.col("_d") + F.col("_s") * F.col("_t")).alias("diagonal")).agg(F.sum(pairs).alias("seeds"))


def _overlaps(hits: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """The stretches of both sequences that meet on each diagonal: keys, start (in a), x, y."""
    mine = a.select(F.col("id").alias("a_id"), F.col("seq").alias("a_seq"))
    theirs = both_strands(b.select("id", "seq")).select(F.col("id").alias("b_id"), "strand", F.col("seq").alias("_q"))  # turned once, not for each diagonal
    pairs = hits.join(theirs, ["b_id", "strand"]).join(mine, "a_id")
    start = F.greatest(F.lit(1), F.col("diagonal") + 1)
    return pairs.select(
        *DIAGONAL, start.alias("start"), F.substring(F.col("a_seq"), start, F.length("_q")).alias("x"), F.substring(F.col("_q"), start - F.col("diagonal"), F.length("_q")).alias("y")
    )


DIAGONAL = ("a_id", "b_id", "strand", "diagonal")


def _equal_bases(x: str, y: str, length: int) -> np.ndarray:
    """Equal bases of each window of ``length``."""
    n = min(len(x), len(y))
    same = np.frombuffer(x[:n].encode(), np.uint8) == np.frombuffer(y[:n].encode(), np.uint8)
    total = np.concatenate(([0], np.cumsum(same)))
    return total[length:] - total[:-length] if n >= length else total[:0]


def _schema(cut: DataFrame, more: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    return ", ".join([*(f"{c} {kinds[c]}" for c in DIAGONAL), more])


def diagonal_identity(hits: DataFrame, a: DataFrame, b: DataFrame, length: int) -> DataFrame:
    """hits(a_id, b_id, strand, diagonal) -> + best: most equal bases of any window of ``length`` on the diagonal, and at: its start in a (the first)."""
    cut = _overlaps(hits, a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [_equal_bases(x, y, length) for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
            best = [int(s.max()) if len(s) else None for s in sums]
            at = [start + int(s.argmax()) if len(s) else None for start, s in zip(batch.column(4).to_pylist(), sums)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(best, pa.int32()), pa.array(at, pa.int32())], [*DIAGONAL, "best", "at"])

    return cut.mapInArrow(run, _schema(cut, "best int, at int"))


def similar_starts(a: DataFrame, b: DataFrame, length: int, least: int, seeds: list[str] = SEEDS) -> DataFrame:
    """a, b(id, seq, perhaps node_id) -> id, s, e: half-open runs of window starts in a with ``least`` equal bases or more to a window of b (of another node), on either strand.

    Found through spaced seeds and verified on whole diagonals, so a window is missed only if no seed hits anywhere on its diagonal.
    """
    found = similar_spans(spaced_hits(a, b, seeds), a, b, length, least, starts=True)
    return merge_intervals(found.select(F.col("a_id").alias("id"), "s", "e"), ["id"])


def similar_spans(hits: DataFrame, a: DataFrame, b: DataFrame, length: int, least: int, starts: bool = False) -> DataFrame:
    """hits -> + s, e: half-open stretches of a under windows of ``length`` with ``least`` equal bases or more on the diagonal; starts: of where these windows start."""
    near, wide = (1, 1) if starts else (length, length)
    cut = _overlaps(hits, a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, s, e = [], [], []
            for i, (start, x, y) in enumerate(zip(*(batch.column(k).to_pylist() for k in (4, 5, 6)))):
                on = np.flatnonzero(_equal_bases(x, y, length) >= least)
                if len(on):
                    turns = np.flatnonzero(np.diff(on) > near)
                    firsts, lasts = on[np.concatenate(([0], turns + 1))], on[np.concatenate((turns, [len(on) - 1]))]
                    rows += [i] * len(firsts)
                    s += (firsts + start).tolist()
                    e += (lasts + start + wide).tolist()
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(rows, pa.int64())) for k in range(4)), pa.array(s, pa.int32()), pa.array(e, pa.int32())], [*DIAGONAL, "s", "e"])

    return cut.mapInArrow(run, _schema(cut, "s int, e int"))


#: Oligos that are compared at once.
LOT = 1 << 12

#: Bases of a sequence whose scores are held at once.
STRETCH = 1 << 16


def perfect_intervals(triplets: np.ndarray, most: int, threshold: float) -> list[tuple[int, int]]:
    """Triplets -> merged half-open ranges of bases under perfect intervals, of 2 to ``most`` triplets.

    An interval of l triplets scores sum of c(c-1)/2 over the counts of its kinds, over l - 1; it is perfect if its score times ten is above the threshold and no interval inside it scores
    more. One step for each length: from all intervals of a length to those longer by one, at all places at once.
    """
    covered = np.zeros(len(triplets) + 3, dtype=np.int64)
    for at in range(0, len(triplets), STRETCH):
        own = triplets[at : at + STRETCH + most]
        n = len(own)
        before = np.zeros(n, dtype=np.int32)  # of the last k triplets, how many are as the one here
        total = np.zeros(n, dtype=np.int32)  # pairs of equal triplets in the interval that starts here
        inside = np.zeros(n, dtype=np.float32)  # the highest score in it
        for k in range(1, min(most, n)):
            before[k:] += own[k:] == own[: n - k]
            total = total[: n - k] + before[k:]
            score = total / np.float32(k)
            inside = np.maximum(score, np.maximum(inside[:-1], inside[1:]))
            hit = np.flatnonzero((10 * score > threshold) & (score >= inside))
            hit = hit[hit < STRETCH] + at
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + k + 3, -1)
    on = np.concatenate(([0], (np.cumsum(covered) > 0).astype(np.int8), [0]))
    return list(zip(np.flatnonzero(np.diff(on) == 1).tolist(), np.flatnonzero(np.diff(on) == -1).tolist()))


def dust_intervals(seqs: DataFrame, window: int = 64, threshold: float = 20.0) -> DataFrame:
    """seqs(id, seq) -> id, s, e: half-open, 1-based stretches of low complexity: the bases under perfect intervals (symmetric DUST) of up to ``window`` bases, joined. Letters beyond ACGT end an interval."""

    def mask(text: str) -> list[tuple[int, int]]:
        base = codes(text).astype(np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (base < 4).astype(np.int8), [0]))))
        out = []
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            own = base[start:end]
            if len(own) > 3:
                out += [(s + start + 1, e + start + 1) for s, e in perfect_intervals((own[:-2] * 16 + own[1:-1] * 4 + own[2:]).astype(np.int8), window - 2, threshold)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, s, e) for i, text in enumerate(batch.column(1).to_pylist()) for s, e in mask(text or "")]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _, _ in found], pa.int64())), pa.array([s for _, s, _ in found], pa.int32()), pa.array([e for _, _, e in found], pa.int32())], ["id", "s", "e"])

    return seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, s int, e int")


_FLIP = np.arange(256, dtype=np.uint8)
_FLIP[[ord(b) for b in S.BASES]] = [ord(b) for b in S.COMPLEMENT]


def hairpins(seqs: DataFrame, stem: int = 6, loops: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """seqs(id, seq) -> id, pos, loop: places where a stem meets its reverse complement after a loop. All places of a sequence are compared at once."""

    def found(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
        for i, text in enumerate(texts):
            base = np.frombuffer((text or "").encode("ascii", "replace"), np.uint8)
            for loop in loops:
                n = len(base) - 2 * stem - loop + 1
                if n > 0:
                    same = np.ones(n, dtype=bool)
                    for k in range(stem):
                        far = 2 * stem + loop - 1 - k
                        same &= _FLIP[base[k : k + n]] == base[far : far + n]
                    at = np.flatnonzero(same) + 1
                    yield i, [at, np.full(len(at), loop)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            yield from row_batches(batch.column(0), found(batch.column(1).to_pylist()), ["id", "pos", "loop"], [pa.int32()] * 2)

    return seqs.select("id", "seq").mapInArrow(run, f"id {seqs.schema['id'].dataType.simpleString()}, pos int, loop int")


def dimers(oligos: np.ndarray, window: int, least: int) -> np.ndarray:
    """Oligos of one length, a column each -> whether a window of each agrees with the oligo's reverse complement in ``least`` bases or more at some shift."""
    n, back, out = len(oligos), _FLIP[oligos[::-1]], np.zeros(oligos.shape[1], dtype=bool)
    kind = np.uint8 if window < 256 else np.int32
    for shift in range(window - n, n - window + 1):
        same = (oligos[max(shift, 0) : n + min(shift, 0)] == back[max(-shift, 0) : n - max(shift, 0)]).astype(kind)
        total = same[:window].sum(axis=0, dtype=kind)
        most = total.copy()
        for k in range(window, len(same)):
            total += same[k]
            total -= same[k - window]
            np.maximum(most, total, out=most)
        out |= most >= least
    return out


def self_dimers(oligos: DataFrame, window: int = 15, least: int = 13) -> DataFrame:
    """oligos(id, seq) -> id, dimer: whether, at some shift, a window of an oligo agrees with its reverse complement in ``least`` bases or more. Oligos of one length are compared together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            texts = [(x or "").encode("ascii", "replace") for x in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in texts])
            found = np.zeros(len(texts), dtype=bool)
            for n in np.unique(sizes[sizes >= window]).tolist():
                own = np.flatnonzero(sizes == n)
                for at in range(0, len(own), LOT):
                    some = own[at : at + LOT]
                    found[some] = dimers(np.ascontiguousarray(np.frombuffer(b"".join([texts[i] for i in some.tolist()]), np.uint8).reshape(-1, n).T), window, least)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_())], ["id", "dimer"])

    return oligos.select("id", "seq").mapInArrow(run, f"id {oligos.schema['id'].dataType.simpleString()}, dimer boolean")
