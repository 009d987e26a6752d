"""SimHash near-duplicates through an index of byte positions.

A fingerprint is one or more bands of 64 bits. Two documents are linked if any of their bands differ in at most 4
bits. Then at most 4 of the band's 8 bytes differ, so at least 4 positional bytes are shared. Posting lists of single bytes
would hold a 256th of all rows each, so a posting is three positions together: 20 of the 56 triples are enough for every
set of 4 positions to hold one (Turan's system for 8 positions). Within a list, the shared positional bytes of each pair are
tallied, pairs that reach the guaranteed minimum of 4 are retained, and only for these bits are counted.

A list of more than ``LIST`` rows is split by a further byte position. Three positions are joined by a fourth: the pairs
that matter share one more. At four, all pairs of a list have reached the minimum, and lists up to ``DEEP`` times as long are searched. Longer ones are
split on: the differing bits lie in the positions that are left, so one of these
has at most its share of them (1, 1, 2, 4), and each row is dealt to its own byte there and to those within that many bits.
No link is lost, and a list whose eight positions are all used has a bounded number of values.

With several bands (drop_near_duplicates) the index only finds candidates: nodes that share a posting of any band, while
all bands together differ in at most a limit of bits. Candidates are joined up, and within each such group the pairs whose sets of
shingles have the asked Jaccard similarity are found exactly (exact_links).

Equal fingerprints are one row from the start. Postings are dealt out and sorted once and read as a stream. Lists are
searched in place and give a spanning forest of links, not all pairs.

Defined results: texts without words (null, empty, white space) have fingerprint 0 and are linked like any other; null
doc_ids get the least id of their component; repeated rows each get a row; an empty table gives an empty result;
extra columns are ignored, whatever their names. drop_near_duplicates returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import as_bytes, groups, ship
from tilewright.llm.graph import connected_components
from tilewright.session import materialize

BITS = 4
LIST = 4096
#: How many times as long a list of four positions or more may be: 65,536 rows take half a megabyte and, at worst, some seconds.
DEEP = 16
SEED = 42
#: Members of a candidate group that are compared in one piece.
BLOCK = 64
#: Shingles that a piece's members are compared on at once.
COLUMNS = 1 << 14
#: Band values whose postings one task makes.
SPREAD = 40_000
#: Bands whose postings are dealt out at once, and postings that a task then sorts; they bound disk and memory.
PASS = 8
#: Bands of the first lot of several.
FIRST = 2
SORTED = 1 << 19
#: Nodes whose links a task remembers.
HELD = 200_000
#: Shingles hashed at once; bounds the memory for long texts.
LOT = 1 << 13
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def covering_triples() -> list[tuple[int, int, int]]:
    """Triples of 8 positions such that any 4 positions include one: three parts in a ring, triples within a part or two of a part and one of the next."""
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    within = [t for part in parts for t in combinations(part, 3)]
    across = [(*two, one) for i, part in enumerate(parts) for two in combinations(part, 2) for one in parts[(i + 1) % 3]]
    return sorted(tuple(sorted(t)) for t in within + across)


def _lots(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles in order, in bounded lots."""
    words = text.translate(LOWER).split()
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    for at in range(0, len(starts), LOT):
        yield np.array([digest(joined[i:j], SEED) for i, j in zip(starts[at : at + LOT].tolist(), ends[at : at + LOT].tolist())], dtype="<u8")


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(np.concatenate([np.zeros(0, dtype="<u8"), *_lots(text, shingle)]))


def fingerprint(text: bytes, shingle: int = 4, bands: int = 1, distinct: bool = False) -> np.ndarray:
    """64-bit bands: a bit is 1 if set in more than half of the hashes of all shingles, repeats included unless distinct. Further bands remix the same hashes."""
    votes, n = np.zeros(bands * 64, dtype=np.int64), 0
    if distinct:
        every = shingle_set(text, shingle)
        lots = (every[at : at + LOT] for at in range(0, len(every), LOT))
    else:
        lots = _lots(text, shingle)
    for some in lots:
        votes += _votes(some, bands)
        n += len(some)
    return np.packbits(votes * 2 > n, bitorder="little").view("<u8")


def _votes(hashes: np.ndarray, bands: int) -> np.ndarray:
    """How many hashes have each bit set, for each band."""
    mixed = np.empty((len(hashes), bands), dtype="<u8")
    mixed[:, 0] = hashes
    for band in range(1, bands):
        x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * band & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        mixed[:, band] = x ^ x >> np.uint64(31)
    bits = np.unpackbits(mixed.view(np.uint8).reshape(len(hashes), bands * 8), axis=1, bitorder="little")
    total = np.zeros(bands * 64, dtype=np.int64)
    for at in range(0, len(bits), 255):  # sums of 255 bits fit a byte
        total += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return total


def fingerprints(docs: DataFrame, shingle: int = 4, bands: int = 1, keep: tuple[str, ...] = ("doc_id",), distinct: bool = False) -> DataFrame:
    """documents(text, keep) -> keep, bands array<long>, a row per row."""
    ship(docs.sparkSession)
    own = docs.select(F.col("text").cast("string").alias("text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "text"):
            prints = [fingerprint(text, shingle, bands, distinct) for text in as_bytes(batch.column(0))]
            flat = pa.array(np.concatenate(prints).view("<i8"), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.ListArray.from_arrays(pa.array(np.arange(len(prints) + 1) * bands, pa.int32()), flat)], [*keep, "bands"])

    return own.mapInArrow(run, ", ".join([*(f"{c} {own.schema[c].dataType.simpleString()}" for c in keep), "bands array<long>"]))


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Tally the shared positional bytes of each pair, retain those with at least 8 - bits, and count bits for these only."""
    x = np.ascontiguousarray(a ^ b)
    out = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - bits
    kept = np.flatnonzero(out)
    out[kept] = np.bitwise_count(x[kept]) <= bits
    return out


class Joined:
    """Which of a task's links join up nodes that weren't yet; forgets all beyond HELD nodes, so memory is bounded and some links may come twice."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def _find(self, x: int) -> int:
        root = x
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def add(self, a: int, b: int) -> bool:
        if len(self.parent) > HELD:
            self.parent.clear()
        a, b = self._find(a), self._find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _search_lists(bits: int, limit: int | None):
    """Lists of (value, node, with a limit also all bands) -> links that span what is near in each list. With a limit, lists hold each node's root so far, and a link between roots that are the same or that the task has joined up already is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()
        for batch in batches:
            lists = batch.column(0)
            rows = lists.flatten()
            values = np.asarray(rows.field("value")).astype(np.int64).view(np.uint64)
            nodes = np.asarray(rows.field("node"))
            roots = nodes if limit is None else np.asarray(rows.field("root"))
            whole = None if limit is None else np.asarray(rows.field("bands").flatten()).astype(np.int64).view(np.uint64).reshape(len(rows), -1)
            offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            sizes = np.diff(offsets)
            us, vs = [], []

            def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                if whole is None:
                    return _near(values[i], values[j], bits)
                return np.bitwise_count(whole[i] ^ whole[j]).sum(axis=-1) <= limit

            for n in range(2, 9):  # short lists of one size together
                at = offsets[:-1][sizes == n]
                for i, j in combinations(range(n), 2) if len(at) else ():
                    hit = near(at + i, at + j)
                    us.append(at[hit] + i)
                    vs.append(at[hit] + j)
            for at, n in zip(offsets[:-1][sizes > 8].tolist(), sizes[sizes > 8].tolist()):
                left, front = np.arange(at, at + n), []
                while len(left):  # a spanning forest, node by node
                    if not front:
                        front, left = [left[0]], left[1:]
                    node = front.pop()
                    hit = near(left, node)
                    found, left = left[hit], left[~hit]
                    us.append(np.full(len(found), node))
                    vs.append(found)
                    front += found.tolist()
            u, v = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (us, vs))
            if limit is not None:
                fresh = np.array([joined.add(a, b) for a, b in zip(roots[u].tolist(), roots[v].tolist())], dtype=bool)
                u, v = u[fresh], v[fresh]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[u], pa.int64()), pa.array(nodes[v], pa.int64())], ["u", "v"])

    return run


def _shared(keys: int, longest: int, names: list[str]):
    """Rows (``keys`` columns of a key, node, more longs) in order of keys -> those of keys with several rows, and whether these are more than ``longest``. Holds no more than a batch and longest rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the rows of the last key, not yet handed on; none of a key that is known to be long
        key, over = None, False

        def rows(columns: list[np.ndarray], long_: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns), pa.array(long_, pa.bool_())], [*names, "long"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(c) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            turn = np.zeros(len(columns[0]) - 1, dtype=bool)
            for c in columns[:keys]:
                turn |= c[1:] != c[:-1]
            starts = np.flatnonzero(np.concatenate(([True], turn)))
            sizes = np.diff(np.concatenate((starts, [len(columns[0])])))
            long_ = sizes > longest
            long_[0] |= over and key == tuple(int(c[0]) for c in columns[:keys])
            done = (sizes > 1) | long_
            last = len(starts) - 1
            over, key = bool(long_[last]), tuple(int(c[-1]) for c in columns[:keys])
            done[last] = over  # the last key may go on
            held = [c[:0] if over else c[starts[last] :] for c in columns]
            pick = np.repeat(done, sizes)
            if pick.any():
                yield rows([c[pick] for c in columns], np.repeat(long_, sizes)[pick])
        if held is not None and len(held[0]) > 1:
            yield rows(held, np.zeros(len(held[0]), dtype=bool))

    return run


#: A row of a list that is to be split: its key (band, the byte positions used as bits, their bytes), node and whole value.
PLACED = ["band", "used", "pattern", "node", "value"]


def _further(bits: int):
    """Rows PLACED -> PLACED with one more position used, for each position and each byte there within the bits that fall to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band, used, pattern, node, value = (np.asarray(c).astype(np.int64) for c in batch.columns)
            for have in np.unique(used).tolist():
                own = used == have
                rest = [p for p in range(8) if not have >> p & 1]
                radius = bits // len(rest) if len(rest) <= bits else 0  # before that, a pair shares a whole byte more
                flips = [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(8), n)]
                for p in rest:
                    for flip in flips:
                        byte = value[own].view(np.uint64) & np.uint64(255 << 8 * p) ^ np.uint64(flip << 8 * p)
                        wide = (pattern[own].view(np.uint64) | byte).view(np.int64)
                        out = [band[own], np.full(own.sum(), have | 1 << p), wide, node[own], value[own]]
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], PLACED)

    return run


def near_links(entries: DataFrame, nodes: DataFrame, bits: int = BITS, longest: int = LIST, limit: int | None = None, known: DataFrame | None = None) -> DataFrame:
    """entries(band, value, id), nodes(id, bands) -> links (u, v) that join up all ids whose values in a band differ in at most ``bits`` (at most 4).

    limit: instead, links join up all ids that share a posting and whose bands together differ in at most so many bits; those of a posting of more than
    ``longest`` are all joined up, whatever they differ in. A node has 20 postings for each band, so the longest posting is a small part of
    the rows that are dealt out. known(node, root), with a limit: what other bands have joined up; links within that are left out.
    """
    ship(entries.sparkSession)
    triples = covering_triples()
    at = lambda p: F.shiftrightunsigned("value", 8 * p).bitwiseAND(F.lit(255))
    key = lambda i, t: F.lit(i).cast("long") * (1 << 24) + at(t[0]) * 65_536 + at(t[1]) * 256 + at(t[2])
    keys = F.array(*(F.col("band").cast("long") * (len(triples) << 24) + key(i, t) for i, t in enumerate(triples)))
    n = max(1, entries.count())
    few = entries.repartition(-(-n // SPREAD))  # each row becomes 20: tasks stay small
    dealt = few.select(F.explode(keys).alias("posting"), F.col("id").alias("node"))
    index = (dealt.repartition("posting") if limit is None else dealt.repartition(-(-n * len(triples) // SORTED), "posting")).sortWithinPartitions("posting")
    listed = materialize(index.mapInArrow(_shared(1, longest, ["posting", "node"]), "posting long, node long, long boolean"), "listed")  # few: most postings stand alone
    band = F.floor(F.col("posting") / (len(triples) << 24)).cast("int")
    own = ["value", "node"] if limit is None else ["value", "node", "bands", "root"]
    found = listed if limit is None else listed.where("not long")
    found = found.join(nodes.select(F.col("id").alias("node"), "bands"), "node").withColumn("value", F.col("bands")[band])
    if limit is not None:
        found = found.join(known, "node", "left").withColumn("root", F.coalesce("root", "node")) if known is not None else found.withColumn("root", F.col("node"))
    short = found.where("not long").groupBy("posting").agg(F.collect_list(F.struct(*own)).alias("rows"))
    links = short.select("rows").mapInArrow(_search_lists(bits, limit), "u long, v long")
    if listed.where("long").isEmpty():
        return links
    if limit is not None:
        heads = materialize(listed.where("long").groupBy("posting").agg(F.min("node").alias("u")), "heads")
        return links.unionByName(listed.where("long").join(heads, "posting").where("u <> node").select("u", F.col("node").alias("v")).distinct())
    used = F.array(*(F.lit(sum(1 << p for p in t)) for t in triples))[F.pmod(F.floor(F.col("posting") / (1 << 24)), F.lit(len(triples))).cast("int")]
    octets = F.array(*(F.lit(sum(255 << 8 * p for p in t) - (1 << 64 if 7 in t else 0)).cast("long") for t in triples))
    octets = octets[F.pmod(F.floor(F.col("posting") / (1 << 24)), F.lit(len(triples))).cast("int")]
    rest = found.where("long").select(band.cast("long").alias("band"), used.cast("long").alias("used"), F.col("value").bitwiseAND(octets).alias("pattern"), "node", "value")
    while True:
        schema = ", ".join(f"{c} long" for c in PLACED)
        split = rest.select(*PLACED).mapInArrow(_further(bits), schema).distinct()
        split = split.repartition("band", "used", "pattern").sortWithinPartitions("band", "used", "pattern")
        placed = materialize(split.mapInArrow(_shared(3, DEEP * longest, PLACED), f"{schema}, long boolean"), "split")
        lists = placed.where("not long or used = 255").groupBy("band", "used", "pattern").agg(F.collect_list(F.struct("value", "node")).alias("rows"))
        links = links.unionByName(lists.select("rows").mapInArrow(_search_lists(bits, None), "u long, v long"))
        rest = placed.where("long and used <> 255")
        if rest.isEmpty():
            return links


def _similar(least: float):
    """Pieces of (id, hashes) -> links that join up the members of a piece whose sets have a Jaccard similarity of ``least`` or more."""

    def shared(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(sets)))
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = times > 1
        pick = several[column]
        owner, column = owner[pick], (np.cumsum(several) - 1)[column[pick]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(several.sum()), COLUMNS):
            i, j = np.searchsorted(column, (at, at + COLUMNS))
            has = np.zeros((len(sets), COLUMNS), dtype=np.float32)
            has[owner[i:j], column[i:j] - at] = 1
            out += has @ has.T
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for k in range(batch.num_rows):
                rows = batch.column(0)[k].values
                piece = dict(zip(rows.field("id").to_pylist(), (np.frombuffer(x, dtype="<u8") for x in rows.field("hashes").to_pylist())))
                ids, sets = list(piece), list(piece.values())
                sizes = np.array([len(x) for x in sets])
                both = shared(sets)
                root = list(range(len(ids)))
                for i, j in np.argwhere(np.triu((both > 0) & (both >= least * (sizes[:, None] + sizes - both) - 1e-9), 1)).tolist():
                    while root[i] != i:
                        i = root[i]
                    while root[j] != j:
                        j = root[j]
                    if i != j:
                        root[max(i, j)] = min(i, j)
                        us.append(ids[i])
                        vs.append(ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def exact_links(members: DataFrame, shingle: int, least: float, block: int = BLOCK) -> DataFrame:
    """members(id, root, text): nodes by candidate group -> links (u, v) that join up the nodes of a group with a Jaccard similarity of ``least`` or more.

    All pairs of a group count. Groups of more than ``block`` are cut into pieces, each with the same two members of the group besides; what these leave apart
    is then compared with all pieces, unless it belongs to what has most members. So a large group of near copies costs its rows and not its pairs.
    """
    ship(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "text"):
            found = [shingle_set(text, shingle).tobytes() for text in as_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["id", "root", "hashes"])

    sets = materialize(members.select("id", "root", "text").mapInArrow(run, "id long, root long, hashes binary"), "sets")
    sizes = sets.groupBy("root").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("n") > block)
    large = materialize(sizes.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "large-groups")

    def links(rows: DataFrame, *keys: str) -> DataFrame:
        pieces = rows.groupBy("root", *keys).agg(F.collect_list(F.struct("id", "hashes")).alias("rows")).where(F.size("rows") > 1)
        return pieces.select("rows").mapInArrow(_similar(least), "u long, v long")

    rows = sets.join(large.select("root", "n", "blocks"), "root", "left").withColumn("piece", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    if large.isEmpty():
        return links(rows, "piece")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    two = large.select("root", "blocks", F.explode(F.array("first", "last")).alias("id")).join(sets.select("id", "hashes"), "id")
    first = materialize(links(rows.select("root", "piece", "id", "hashes").unionByName(two.select("root", upto("blocks").alias("piece"), "id", "hashes")), "piece"), "similar")
    joined = connected_components(first).select(F.col("node").alias("id"), F.col("root").alias("part"))
    parted = materialize(rows.where("n is not null").join(joined, "id", "left").withColumn("part", F.coalesce("part", "id")), "parted")
    parts = parted.groupBy("root", "part").agg(F.count("*").alias("m"), F.first("n").alias("n"))
    most = parts.groupBy("root").agg(F.max(F.struct("m", "part")).alias("most"), F.first("n").alias("n")).where("most.m < n")
    most = materialize(most.select("root", F.col("most.part").alias("main"), F.ceil((F.col("n") - F.col("most.m")) / block).cast("int").alias("rest")), "most")
    apart = parted.join(most, "root")
    ones = apart.where("part <> main").withColumn("other", F.pmod(F.xxhash64("id", F.lit(1)), F.col("rest")).cast("int")).select("root", "other", upto("blocks").alias("piece"), "id", "hashes")
    every = apart.select("root", upto("rest").alias("other"), "piece", "id", "hashes")
    return first.unionByName(links(ones.unionByName(every), "other", "piece"))


def components(prints: DataFrame, bits: int = BITS, longest: int = LIST, limit: int | None = None, verify: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """prints(doc_id, bands, ...) -> + root (names the component) and component_id: the least doc_id reachable over links, its own included.

    verify: makes links (u, v) of members(id, root, key), the nodes of each component with the key of one of its rows; these links count then.
    """
    most = prints.select(F.max(F.size("bands"))).first()[0] or 1
    groups_ = prints.groupBy("bands").agg(F.min("doc_id").alias("doc_id"), *([F.min("key").alias("key")] if verify else []))
    nodes = materialize(groups_.withColumn("id", F.col("bands")[0] if most == 1 else F.monotonically_increasing_id()), "nodes")  # written once: ids stay
    entries = nodes.select("id", F.posexplode("bands").alias("band", "value"))
    lot = lambda i, j: entries.where((F.col("band") >= i) & (F.col("band") < j))
    if limit is None:
        links = reduce(DataFrame.unionByName, [near_links(lot(i, i + PASS), nodes, bits, longest) for i in range(0, most, PASS)])
    else:  # near copies meet in lists of every band: the few of the first lot join most of them up, and later lots add only what that leaves apart
        cuts, links, known = [0, *range(min(FIRST, most), most, PASS), most], None, None
        for i, j in zip(cuts, cuts[1:]):
            more = materialize(near_links(lot(i, j), nodes, bits, longest, limit, known), "near-links")
            links = more if links is None else links.unionByName(more)
            known = connected_components(links) if j < most else None
    if verify:
        near = materialize(connected_components(links).withColumnRenamed("node", "id"), "candidates")
        links = verify(near.join(nodes.select("id", "key"), "id"))
    roots = materialize(connected_components(links).withColumnRenamed("node", "id"), "roots")
    least = roots.join(nodes.select("id", "doc_id"), "id").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = roots.join(least, "root").select("id", "root", "component_id")
    labels = nodes.select("id", "bands", "doc_id").join(linked, "id", "left").select("bands", F.coalesce("root", "id").alias("root"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return prints.join(materialize(labels, "labels"), "bands").select(*prints.columns, "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, longest: int = LIST) -> DataFrame:
    """documents(doc_id, text) -> doc_id, bands, root, component_id, a row per row."""
    return components(materialize(fingerprints(docs, shingle), "fingerprints"), longest=longest)


def similar_documents(keyed: DataFrame, shingle: int = 5, least: float = 0.8, bands: int = 16, share: float = 0.22, longest: int = LIST) -> DataFrame:
    """documents(doc_id, text, key), key the same for equal rows only -> doc_id, key, bands, root, component_id, a row per row.

    Links are the pairs of word shingle sets with a Jaccard similarity of ``least`` or more. Sets of similarity 0.8 differ in 15% of the bits; those
    within ``share`` that agree in one of the index's triples of bytes are candidates.
    """

    def verify(members: DataFrame) -> DataFrame:
        texts = keyed.select("key", F.col("text").cast("string").alias("text")).join(members, "key")
        return exact_links(texts.groupBy("id", "root").agg(F.first("text").alias("text")), shingle, least)

    prints = materialize(fingerprints(keyed, shingle, bands, ("doc_id", "key"), distinct=True), "fingerprints")
    return components(prints, longest=longest, limit=int(share * 64 * bands), verify=verify)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of documents but for near copies: of each group the one with the least doc_id (nulls last, then by text) stays.

    Groups are joined up by pairs whose sets of word shingles have a Jaccard similarity of ``least`` or more, each verified on the sets.
    A row is known by a digest of its doc_id and text (SHA-256). Of rows with the same digest the first in order of their other columns stays.
    """
    inner = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)))
    doc_id, text = (F.col(f"_{docs.columns.index(c)}") for c in ("doc_id", "text"))
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit("|"), text.cast("string")), F.lit("")))
    keyed = inner.select("*", doc_id.cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("key"))
    found = similar_documents(keyed, shingle, least)
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key").alias("key")))["key"]
    stay = materialize(found.groupBy("root").agg(best.alias("key"), F.min("component_id")).select("key"), "stay")
    names = [F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)]
    twice = materialize(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").join(stay, "key", "left_semi").select("key"), "twice")
    if twice.isEmpty():
        return keyed.join(stay, "key", "left_semi").select(*names)
    # only the rows of repeated keys are gathered, as partial minima
    rows = [f"_{i}" for i in range(len(docs.columns))]
    others = [F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in rows if c not in (f"_{docs.columns.index('text')}",)]
    once = keyed.join(stay.join(twice, "key", "left_anti"), "key", "left_semi").select(*rows)
    again = keyed.join(twice, "key", "left_semi").groupBy("key").agg(F.min_by(F.struct(*rows), F.concat_ws("|", *others)).alias("row")).select("row.*")
    return once.unionByName(again).select(*names)
