"""Families of genes -> clusters: alignment, distances, UPGMA, consensus, CIGARs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.functions import cigar, seq as S
from tilewright.operators.kmers import codes
from tilewright.session import materialize

GAP = "-"


def family_name(name_column: str, pattern: str):
    """The first match of a pattern in a gene's name, or the whole name; UNKNOWN without one."""
    name = F.coalesce(F.nullif(F.col(name_column), F.lit("")), F.lit("UNKNOWN"))
    return F.coalesce(F.nullif(F.regexp_extract(name, pattern, 0), F.lit("")), name)


def split_singletons(genes: DataFrame, family: str = "family") -> tuple[DataFrame, DataFrame]:
    """(families of one, larger families); both keep the columns of genes."""
    counted = genes.withColumn("_n", F.count("*").over(W.partitionBy(family)))
    return counted.where("_n = 1").drop("_n"), counted.where("_n > 1").drop("_n")


def singleton_clusters(single: DataFrame) -> DataFrame:
    """genes(family, uid, seq) of families of one -> cluster_id, uid, seq, cigar."""
    return single.select(F.concat("family", F.lit("_00000")).alias("cluster_id"), "uid", "seq", F.concat(F.length("seq").cast("string"), F.lit("=")).alias("cigar"))


# ---------------------------------------------------------------- alignment


def global_alignment(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Needleman-Wunsch by rows of NumPy, moves kept as bytes; ties prefer the diagonal, then a gap in b."""
    n, m = len(a), len(b)
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    steps = np.arange(m + 1) * gap
    score, move = steps.copy(), np.zeros((n + 1, m + 1), dtype=np.uint8)
    move[0, 1:], move[1:, 0] = 2, 1
    for i in range(1, n + 1):
        diagonal = score[:-1] + np.where(y == x[i - 1], match, mismatch)
        best = np.concatenate(([score[0] + gap], np.maximum(diagonal, score[1:] + gap)))
        run = np.maximum.accumulate(best - steps) + steps  # gaps along the row, all at once
        move[i, 1:] = np.where(run[1:] == diagonal, 0, np.where(run[1:] == score[1:] + gap, 1, 2))
        score = run
    out, i, j = [], n, m
    while i or j:
        k = move[i, j]
        out.append((a[i - 1] if k != 2 else GAP, b[j - 1] if k != 1 else GAP))
        i, j = i - (k != 2), j - (k != 1)
    out.reverse()
    return "".join(p for p, _ in out), "".join(q for _, q in out)


def star_alignment(seqs: list[str]) -> list[str]:
    """Aligns all sequences to the longest (the first of equals); gaps it once gets stay."""
    if len(set(seqs)) == 1:
        return list(seqs)
    centre = max(range(len(seqs)), key=lambda i: (len(seqs[i]), -i))
    rows, order = [seqs[centre]], [centre]
    for i, s in enumerate(seqs):
        if i == centre:
            continue
        c, other = global_alignment(rows[0].replace(GAP, ""), s)
        merged, fresh, p, q = [""] * len(rows), "", 0, 0
        while p < len(rows[0]) or q < len(c):
            old = p < len(rows[0]) and rows[0][p] == GAP
            new = q < len(c) and c[q] == GAP
            take_old, take_new = not new or old, not old or new
            for r, row in enumerate(rows):
                merged[r] += row[p] if take_old else GAP
            fresh += other[q] if take_new else GAP
            p, q = p + take_old, q + take_new
        rows = [*merged, fresh]
        order.append(i)
    return [row for _, row in sorted(zip(order, rows))]


def translate(s: str, code: str = S.STANDARD_CODE) -> str:
    at = {b: i for i, b in enumerate(S.CODON_BASES)}
    return "".join(code[16 * at[c[0]] + 4 * at[c[1]] + at[c[2]]] if all(b in at for b in c) else "X" for c in (s[i : i + 3] for i in range(0, len(s) - len(s) % 3, 3)))


def align_by_protein(seqs: list[str], code: str = S.STANDARD_CODE) -> list[str]:
    """Aligns translations and threads the codons back: a gap becomes three, bases after the last whole codon go to the end, padded."""
    proteins = star_alignment([translate(s, code) for s in seqs])
    out = []
    for s, protein in zip(seqs, proteins):
        codons = iter(s[i : i + 3] for i in range(0, len(s) - len(s) % 3, 3))
        out.append("".join(GAP * 3 if p == GAP else next(codons) for p in protein) + s[len(s) - len(s) % 3 :])
    width = max(map(len, out), default=0)
    return [s.ljust(width, GAP) for s in out]


def align_families(genes: DataFrame, by_protein: bool = True, code: str = S.STANDARD_CODE) -> DataFrame:
    """genes(family, uid, seq) -> family, uid, aligned: one multiple alignment per family (a gene family, small by nature)."""

    def align(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("uid")
        texts = df["seq"].str.upper().tolist()
        return pd.DataFrame({"family": df["family"], "uid": df["uid"], "aligned": align_by_protein(texts, code) if by_protein else star_alignment(texts)})

    return genes.select("family", "uid", "seq").groupBy("family").applyInPandas(align, "family string, uid string, aligned string")


# ---------------------------------------------------------------- distances and clusters


#: Rows and bases of a family's block: its pairs are made a cell, that is block against block, at a time.
BLOCK_ROWS, BLOCK_BASES = 1 << 11, 1 << 24

#: Pairs of rows and words of 64 bases that are compared at once, and rows of a result that travel together.
TILE, WORDS, LOT = 1 << 14, 1 << 17, 1 << 16

#: Pairs, compared bases and bases held of one task.
TASK_PAIRS, TASK_COMPARED, TASK_BASES = 1 << 21, 1 << 33, 1 << 26


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """A stream sorted by its first columns -> a table for each of their values, which are not null."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n, turns = batch.num_rows, np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        if not n:
            continue
        for c in batch.columns[:keys]:
            turns |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, n - 1)))
        cuts = [0, *(np.flatnonzero(turns) + 1).tolist(), n]
        if held and any(held[0].column(k)[0] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        for i, j in zip(cuts, cuts[1:]):
            if i and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _lots(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together to about LOT rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        held.append(part)
        size += part.num_rows
        if size >= LOT:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _in_cells(aligned: DataFrame) -> tuple[DataFrame, int]:
    """aligned(family, uid, aligned) -> (family, cell, side, uid, aligned, dealt out by family and cell and sorted by these and uid; the number of tasks).

    A family of more than a block's rows or bases is dealt to blocks; each pair of blocks is a cell, its rows on side 0 and 1, and so is each block alone (side -1). Each pair of rows meets in one cell.
    """
    rows = aligned.select("family", "uid", "aligned").where("family is not null and uid is not null")
    sizes = materialize(rows.groupBy("family").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length("aligned"), F.lit(0))).alias("bases")), "families")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.least("n", F.ceil(F.col("bases") / BLOCK_BASES)))
    total = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"), F.sum((F.col("n") - 1) / 2 * F.col("bases")).alias("compared"), F.sum(F.col("bases") * blocks).alias("bases")).first()
    tasks = max(aligned.sparkSession.sparkContext.defaultParallelism, *(int((x or 0) // y) for x, y in ((total.pairs, TASK_PAIRS), (total.compared, TASK_COMPARED), (total.bases, TASK_BASES))))
    large = sizes.select("family", blocks.cast("int").alias("_k")).where("_k > 1")  # as small as the table is written, so Spark may broadcast it
    dealt = rows.join(large, "family", "left").withColumn("_k", F.coalesce("_k", F.lit(1))).withColumn("_i", F.pmod(F.xxhash64("uid", "aligned"), "_k").cast("int"))
    dealt = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    cell = F.least("_i", "_j").cast("long") * F.col("_k") + F.greatest("_i", "_j")
    side = F.when(F.col("_i") == F.col("_j"), -1).otherwise((F.col("_i") > F.col("_j")).cast("int"))
    return dealt.select("family", cell.alias("cell"), side.alias("side"), "uid", "aligned").repartition(tasks, "family", "cell").sortWithinPartitions("family", "cell", "uid"), tasks


_BASE = np.full(256, 4, dtype=np.uint8)
_BASE[[ord(c) for c in S.BASES]] = range(len(S.BASES))


def _bit_planes(texts: list[str | None]) -> np.ndarray:
    """(3, words, rows): for each of A, C, G, T the two bits of its code and one that it is there; 64 columns a word."""
    out = np.zeros((3, len(texts), -(-max(max(len(t or "") for t in texts), 1) // 64) * 8), dtype=np.uint8)
    for i, text in enumerate(texts):
        base = _BASE[np.frombuffer((text or "").encode("ascii", "replace"), np.uint8)]
        for plane, bits in enumerate((base & 1, base & 2, base < 4)):
            out[plane, i, : -(-len(base) // 8)] = np.packbits(bits)
    return np.ascontiguousarray(out.view(np.uint64).transpose(0, 2, 1))


def _bits(x: np.ndarray, y: np.ndarray, words: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Bits set in what ``words`` makes of the planes of each of x and each of y."""
    out = np.zeros((x.shape[2], y.shape[2]), dtype=np.int32)
    few = out.size < TILE // 4
    step = max(1, WORDS // out.size) if few else 3  # bits of three words can be counted in a byte
    for at in range(0, x.shape[1], step):
        found = np.bitwise_count(words(x[:, at : at + step, :, None], y[:, at : at + step, None]))
        out += found.sum(axis=0, dtype=np.int32 if few else np.uint8)
    return out


def _distances(x: np.ndarray, y: np.ndarray, gap_penalty: float) -> np.ndarray:
    """Planes of rows -> the distance of each of x to each of y."""
    if (x[2] == x[2, :, :1]).all() and (y[2] == x[2, :, :1]).all():  # bases in the same columns
        over = np.full((x.shape[2], y.shape[2]), float(np.bitwise_count(x[2, :, 0]).sum()))
        same = over - _bits(x, y, lambda p, q: (p[0] ^ q[0]) | (p[1] ^ q[1]))
    else:
        same = _bits(x, y, lambda p, q: p[2] & q[2] & ~((p[0] ^ q[0]) | (p[1] ^ q[1])))
        over = _bits(x, y, lambda p, q: p[2] & q[2]) + _bits(x, y, lambda p, q: p[2] ^ q[2]) * gap_penalty
    return np.where(over > 0, 1 - same / np.where(over > 0, over, 1), -1.0)


def _cell_distances(side: np.ndarray, planes: np.ndarray, gap_penalty: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows of a cell, and rows to compare them with -> their distances, a tile at a time. Within a block: each row with those after it, at least."""
    one, other = (np.arange(len(side)),) * 2 if side[0] < 0 else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    x, y = (np.ascontiguousarray(planes[:, :, rows]) for rows in (one, other))
    high, wide = 64, TILE // 64
    for i in range(0, len(one), high):
        for j in range(i if side[0] < 0 else 0, len(other), wide):
            yield one[i : i + high], other[j : j + wide], _distances(x[:, :, i : i + high], y[:, :, j : j + wide], gap_penalty)


def _rank(uids: pa.Array) -> np.ndarray:
    """Sorted ids -> their places, equal ones the same."""
    return np.concatenate(([0], np.cumsum(np.asarray(pc.not_equal(uids.slice(1), uids.slice(0, len(uids) - 1))))))


def pairwise_distance(aligned: DataFrame, gap_penalty: float = 0.0) -> DataFrame:
    """aligned(family, uid, aligned) -> family, a, b (a < b), d = 1 - same / (columns - gaps + gaps * penalty); -1 if nothing is comparable.

    same: columns in which both have the same of A, C, G, T; gaps: columns in which just one has a base, anything else being a gap; columns of two gaps don't count.
    Rows are packed to bits and meet block by block: no pair carries its sequences, and a task holds two blocks.
    """
    names = ["family", "a", "b", "d"]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches, 2):
            side, uids = np.asarray(cell.column("side")), cell.column("uid").chunk(0)
            if len(uids) < 2:
                continue
            rank, family = _rank(uids), cell.column("family")[0]
            for left, right, d in _cell_distances(side, _bit_planes(cell.column("aligned").to_pylist()), gap_penalty):
                before, after = rank[left][:, None] < rank[right], rank[left][:, None] > rank[right]
                i, j = np.nonzero(before if side[0] < 0 else before | after)
                a, b = left[i], right[j]
                turn = rank[a] > rank[b]
                a, b = np.where(turn, b, a), np.where(turn, a, b)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.repeat(family, len(a)), uids.take(pa.array(a)), uids.take(pa.array(b)), pa.array(d[i, j], pa.float64())], names)

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    return _in_cells(aligned)[0].mapInArrow(lambda batches: _lots(pairs(batches)), f"family {kinds['family']}, a {kinds['uid']}, b {kinds['uid']}, d double")


def upgma_tree(n: int, distance: np.ndarray, size: list[int] | None = None) -> list[tuple[int, int, float]]:
    """Average linkage: merges (node, node, height), the k-th making node n + k; the height is half the distance. Ties take the first pair. size: of how many rows each leaf stands for.

    Each row keeps its nearest later one, so a merge looks through few rows, not through the matrix.
    """
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, node, out = [1] * n if size is None else list(size), list(range(n)), []
    least, at = np.full(n, np.inf), np.zeros(n, dtype=np.int64)

    def look(i: int) -> None:
        if i + 1 < n:
            at[i] = i + 1 + d[i, i + 1 :].argmin()
            least[i] = d[i, at[i]]

    for i in range(n):
        look(i)
    for k in range(n - 1):
        i = int(least.argmin())
        j = int(at[i])
        out.append((node[i], node[j], float(d[i, j]) / 2))
        d[i] = d[:, i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[j] = d[:, j] = np.inf
        d[i, i] = np.inf
        size[i], node[i] = size[i] + size[j], n + k
        least[j] = np.inf
        for row in np.flatnonzero((least[:j] < np.inf) & ((at[:j] == i) | (at[:j] == j))).tolist():
            look(row)
        look(i)
        near = (d[:i, i] < least[:i]) | ((d[:i, i] == least[:i]) & (i < at[:i]))
        least[:i][near], at[:i][near] = d[:i, i][near], i
    return out


def cut_tree(n: int, merges: list[tuple[int, int, float]], cut: float, reroot: bool = False) -> list[int]:
    """Labels of the leaves, from 0 by first member: the largest subtrees none of whose leaves is further than ``cut`` from their root.

    reroot: first, if a branch is longer than the two at the root together, the root moves to the middle of the longest branch.
    """
    if n < 2:
        return [0] * n
    height = [0.0] * n + [h for *_, h in merges]
    below: dict[int, list[tuple[int, float]]] = {n + k: [(x, h - height[x]) for x in (a, b)] for k, (a, b, h) in enumerate(merges)}
    root = n + len(merges) - 1
    branches = [(length, node, x) for node, own in below.items() if node != root for x, length in own]
    longest = max(branches, key=lambda e: (e[0], -e[2]), default=(0.0, 0, 0))
    if reroot and longest[0] > sum(length for _, length in below[root]):
        (x, first), (y, second) = below.pop(root)
        near: dict[int, list[tuple[int, float]]] = {}
        length, upper, lower = longest
        for a, b, n_ab in [(x, y, first + second), *((node, c, m) for node, own in below.items() for c, m in own if (node, c) != (upper, lower))]:
            near.setdefault(a, []).append((b, n_ab))
            near.setdefault(b, []).append((a, n_ab))
        below, todo = {root: [(upper, length / 2), (lower, length / 2)]}, [(upper, root), (lower, root)]
        while todo:
            at, above = todo.pop()
            own = [(c, m) for c, m in near.get(at, []) if c != above]
            if own:
                below[at] = own
                todo += [(c, at) for c, _ in own]
    order = [root]
    for node in order:
        order += [c for c, _ in below.get(node, [])]
    depth: dict[int, float] = {}
    for node in reversed(order):
        depth[node] = max((depth[c] + m for c, m in below.get(node, [])), default=0.0)
    group: dict[int, int] = {root: -1}
    leaves: dict[int, list[int]] = {}
    for node in order:  # a node within the cut takes all below it along
        if group[node] < 0 and (depth[node] <= cut or node not in below):
            group[node] = node
        for c, _ in below.get(node, []):
            group[c] = group[node]
        if node < n:
            leaves.setdefault(group[node], []).append(node)
    label = [0] * n
    for k, own in enumerate(sorted(leaves.values(), key=min)):
        for i in own:
            label[i] = k
    return label


def upgma_labels(n: int, distance: np.ndarray, cut: float, reroot: bool = False) -> list[int]:
    """Labels of the subtrees no higher than ``cut`` (half the distance)."""
    return cut_tree(n, upgma_tree(n, distance), cut, reroot)


def upgma_clusters(distances: DataFrame, cut: float, reroot: bool = False) -> DataFrame:
    """distances(family, a, b, d), all pairs of a family -> family, uid, part: subtrees no higher than ``cut``; reroot: after the root moved to the longest branch's middle."""

    def label(df: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(df["a"]) | set(df["b"]))
        at = {x: i for i, x in enumerate(names)}
        d = np.zeros((len(names), len(names)))
        i, j = df["a"].map(at).to_numpy(), df["b"].map(at).to_numpy()
        d[i, j] = d[j, i] = np.where(df["d"] < 0, 1.0, df["d"])
        return pd.DataFrame({"family": df["family"].iloc[0], "uid": names, "part": upgma_labels(len(names), d, cut, reroot)})

    return distances.groupBy("family").applyInPandas(label, "family string, uid string, part int")


def _first_of_linked(n: int, links: Iterator[tuple[int, int]]) -> list[int]:
    """Links of 0 to n - 1 -> for each the least that it is linked with."""
    first = list(range(n))

    def root(i: int) -> int:
        while first[i] != i:
            first[i] = i = first[first[i]]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        first[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


def _forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Symmetric links -> the least of each part with each other member."""
    free = linked.any(axis=1)
    for i in np.flatnonzero(free).tolist():
        if free[i]:
            part, front = np.zeros(len(free), dtype=bool), np.array([i])
            while len(front):
                part[front], free[front] = True, False
                front = np.flatnonzero(linked[front].any(axis=0) & free)
            yield from ((i, j) for j in np.flatnonzero(part).tolist() if j != i)


def _with_copies(distance: np.ndarray, copies: list[int]) -> np.ndarray:
    """Distances of rows after the copies of each were merged, first to first: means of equal numbers, rounded at each step as the tree does."""
    d = distance.copy()
    for i, n in enumerate(copies):
        own, mean = d[i].copy(), d[i]
        for k in range(1, n):
            mean = (k * mean + own) / (k + 1)
        d[i] = d[:, i] = mean
    return d


def family_clusters(aligned: DataFrame, cut: float) -> DataFrame:
    """aligned(family, uid, aligned) -> family, uid, part: as upgma_clusters of all pairwise distances, for families of several uids; pairs are never rows.

    Copies of a text are one leaf. A subtree no higher than ``cut`` lies within what pairs of at most twice that distance link together, and the merges in such a part don't depend on
    other rows; so cells look for links, and each part has a tree of its own. A part of n different texts is one task's, which holds n * n distances.
    """
    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    most = 2 * cut + 1e-9  # more than rounding in means of distances
    own = F.when(F.col("aligned").rlike(f"[{S.BASES}]"), None).otherwise(F.col("uid"))  # without a base it is as far from its copies as from any
    rows = aligned.where("family is not null and uid is not null").select("family", "uid", F.coalesce("aligned", F.lit("")).alias("aligned"), own.alias("_own")).withColumn("_key", F.md5("aligned"))
    members = rows.select("family", "uid", "_key", "_own")
    texts = materialize(rows.groupBy("family", "_key", "_own").agg(F.min("uid").alias("uid"), F.max("uid").alias("last"), F.count("*").alias("n"), F.any_value("aligned").alias("aligned")), "texts")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches, 2):
            n, side, uids = cell.num_rows, np.asarray(cell.column("side")), cell.column("uid").chunk(0)
            linked = np.zeros((n, n), dtype=bool)
            if n > 1:
                for left, right, d in _cell_distances(side, _bit_planes(cell.column("aligned").to_pylist()), 0.0):
                    linked[left[:, None], right] = np.where(d < 0, 1.0, d) <= most
                linked |= linked.T
                np.fill_diagonal(linked, False)
                found = np.array(list(_forest(linked)), dtype=np.int64).reshape(-1, 2)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.repeat(cell.column("family")[0], len(found)), uids.take(pa.array(found[:, 0])), uids.take(pa.array(found[:, 1]))], ["family", "a", "b"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            a, b = (group.column(c).chunk(0) for c in ("a", "b"))
            uids = pa.concat_arrays([a, b]).unique()
            uids = uids.take(pc.sort_indices(uids))
            first = _first_of_linked(len(uids), zip(*(pc.index_in(c, value_set=uids).to_pylist() for c in (a, b))))
            yield pa.RecordBatch.from_arrays([pa.repeat(group.column("family")[0], len(uids)), uids, uids.take(pa.array(first))], ["family", "uid", "linked"])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 2):
            n, uids = group.num_rows, group.column("uid").chunk(0)
            planes, distance = _bit_planes(group.column("aligned").to_pylist()), np.zeros((n, n))
            for left, right, d in _cell_distances(np.full(n, -1), planes, 0.0):
                d = np.where(d < 0, 1.0, d)
                distance[left[:, None], right] = d
                distance[right[:, None], left] = d.T
            np.fill_diagonal(distance, 0)
            copies = group.column("n").to_pylist()
            label = cut_tree(n, upgma_tree(n, _with_copies(distance, copies), copies), cut)
            head = [label.index(x) for x in range(max(label) + 1)]
            yield pa.RecordBatch.from_arrays([pa.repeat(group.column("family")[0], n), uids, uids.take(pa.array([head[x] for x in label]))], ["family", "uid", "head"])

    cells, tasks = _in_cells(texts)
    pairs = cells.mapInArrow(lambda batches: _lots(links(batches)), f"family {kinds['family']}, a {kinds['uid']}, b {kinds['uid']}")
    parts = pairs.repartition("family").sortWithinPartitions("family").mapInArrow(lambda batches: _lots(joined(batches)), f"family {kinds['family']}, uid {kinds['uid']}, linked {kinds['uid']}")
    whole = texts.join(parts, ["family", "uid"]).select("family", "linked", "uid", "n", "aligned").repartition(tasks, "family", "linked").sortWithinPartitions("family", "linked", "uid")
    head = whole.mapInArrow(lambda batches: _lots(heads(batches)), f"family {kinds['family']}, uid {kinds['uid']}, head {kinds['uid']}")
    ends = texts.groupBy("family").agg(F.min("uid").alias("_a"), F.max("last").alias("_b")).where("_a < _b").select("family")
    found = texts.select("family", "uid", "_key", "_own").join(ends, "family", "left_semi").join(head, ["family", "uid"], "left").withColumn("head", F.coalesce("head", "uid"))
    found = found.select("family", "_key", "_own", (F.dense_rank().over(W.partitionBy("family").orderBy("head")) - 1).cast("int").alias("part"))
    same = (F.col("m.family") == F.col("t.family")) & (F.col("m._key") == F.col("t._key")) & F.col("m._own").eqNullSafe(F.col("t._own"))
    return members.alias("m").join(found.alias("t"), same).groupBy("m.family", "m.uid").agg(F.min("t.part").alias("part"))


def _voted(aligned: DataFrame, keys: list[str], name: str, gaps: bool) -> DataFrame:
    """Rows sorted by keys are read as a stream, with the votes of one key's columns held at a time: no row per base, and each row is dealt out once."""
    columns = [*keys, "aligned"]
    rows = aligned.select(*columns).where(F.col("aligned").isNotNull()).repartition(*keys).sortWithinPartitions(*keys)
    bases = np.frombuffer((S.BASES + GAP).encode(), np.uint8)

    def text(votes: np.ndarray) -> str:
        best = np.where(votes.any(axis=0), votes.argmax(axis=0), len(S.BASES))  # of equals the first, the least letter
        return bases[best if gaps else best[best < len(S.BASES)]].tobytes().decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, votes = None, np.zeros((len(S.BASES), 0), dtype=np.int64)

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.concat_arrays([key[i] for key, _ in done]) for i in range(len(keys))), pa.array([x for _, x in done], pa.string())], [*keys, name])

        for batch in batches:
            done: list[tuple] = []
            values = list(zip(*(c.to_pylist() for c in batch.columns[:-1]))) if keys else [()] * batch.num_rows
            for i, sequence in enumerate(batch.column(len(keys)).to_pylist()):
                if held is None or values[i] != held[0]:
                    if held is not None:
                        done.append((held[1], text(votes)))
                    held, votes = (values[i], [c.slice(i, 1) for c in batch.columns[:-1]]), np.zeros((len(S.BASES), len(sequence)), dtype=np.int64)
                if len(sequence) > votes.shape[1]:
                    votes = np.pad(votes, ((0, 0), (0, len(sequence) - votes.shape[1])))
                base = codes(sequence)
                at = np.flatnonzero(base < len(S.BASES))
                votes[base[at], at] += 1
            if done:
                yield batch_of(done)
        if held is not None:
            yield batch_of([(held[1], text(votes))])

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"{name} string"]))


def consensus(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """aligned(keys, aligned) -> keys, seq: each column's most frequent base, of equals the least letter; columns without a base drop out."""
    return _voted(aligned, keys, "seq", False).where("seq <> ''")


def aligned_consensus(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """The same with a gap for columns in which no row of the key has a base, so it lines up with the rows."""
    return _voted(aligned, keys, "reference", True)


def cluster_genes(genes: DataFrame, divergence: float = 0.15, table: int = 1, reroot: bool = True) -> tuple[DataFrame, DataFrame]:
    """genes(family, uid, seq) -> (clusters(cluster_id, seq), members(cluster_id, uid, cigar)). table: genetic code through which families are aligned; 0 aligns bases. reroot: trees are rooted anew at their longest branch before they are cut."""
    single, many = split_singletons(genes)
    alone = singleton_clusters(single)
    code = S.genetic_code(table) if table else ""
    aligned = materialize(align_families(many, table > 0, code), "aligned")  # read three times
    parts = upgma_clusters(pairwise_distance(aligned), divergence / 2, reroot) if reroot else family_clusters(aligned, divergence / 2)
    named = aligned.join(parts, ["family", "uid"]).withColumn("cluster_id", F.concat_ws("_", "family", F.format_string("%05d", "part")))
    reference = aligned_consensus(named, ["cluster_id"])
    members = named.join(reference, "cluster_id").select("cluster_id", "uid", cigar.build(F.col("aligned"), F.col("reference")).alias("cigar"))
    clusters = reference.select("cluster_id", F.regexp_replace("reference", GAP, "").alias("seq"))
    return clusters.unionByName(alone.select("cluster_id", "seq")), members.unionByName(alone.select("cluster_id", "uid", "cigar"))
