"""Balanced tiling within a budget of probes: classes of organisms, target densities of regions, and trimming.

Regions: region_id, len, ...; region_org(region_id, org) says which organisms a region covers. The choices for one region change what its
organisms still need, and with it the choices for later regions, so these steps are scans in a fixed order. A scan holds two numbers
per organism and no regions: regions of several organisms are scanned per group of organisms that share any, and those of a single
organism afterwards per organism, as no other organism depends on them. Spark sorts the regions for it and may spill; only numbers
per organism and the sets of organisms that share regions, which are nodes of a tree, meet on the driver. Rows name their set by a number, so
what holds for a set is sent to them and no step joins regions to their organisms again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from heapq import heapreplace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tilewright.session import discard, materialize

ROW = ["region_id", "set", "rank", "len", "begin", "density", "probes"]


# ---------------------------------------------------------------- numbers of one region, as select.py has them for columns


def densest(length: int, probe: int) -> int:
    return probe if length >= 2 * probe - 1 else length - probe + 1


def step_of(length: int, density: int, probe: int) -> int:
    if density <= 1:
        return probe
    return max(1, ((length - probe) if length < 2 * probe else (probe - 1)) // (density - 1))


def baits_of(length: int, density: int, probe: int) -> int:
    return -(-(length - probe + 1) // step_of(length, density, probe))


def density_for(length: int, a: int, b: int, probe: int) -> int:
    """The density at which a region takes about a / b probes."""
    if a == b * (-(-(length + 1) // probe) - 1):
        return 1
    spare = length - probe if length < 2 * probe else probe - 1
    return a * spare // (b * (length - probe + 1)) + 1


def shorten(length: int, begin: int, density: int, target: int, probe: int) -> tuple[int, int, int, int]:
    """A shorter stretch about the same middle that takes ``target`` probes or fewer: length, begin, density, probes."""
    whole, baits = length, baits_of(length, density, probe)
    while baits > target:
        length = target * step_of(length, density, probe) + probe - 1
        density = min(density, densest(length, probe))
        baits = baits_of(length, density, probe)
    return length, begin + (whole - length) // 2, density, baits


# ---------------------------------------------------------------- regions by sets of organisms


@dataclass(frozen=True)
class Tiles:
    """rows(region_id, set, rank, len, begin, ...) and their sets: orgs, n (regions) and sums of columns, at the number that ``set`` names.

    rank orders an organism's regions, equal ones by region_id: a number, or an array with one for each of orgs. probes: the sum of each set's, once regions have them.
    """

    rows: DataFrame
    sets: list[Row]
    probes: dict[int, int] | None = None


def by_sets(regions: DataFrame, *summed: str) -> Tiles:
    """regions(region_id, orgs (sorted), rank, ...) -> the same, written, with the number of its set in place of orgs."""
    written = materialize(regions, "held")
    sets = written.groupBy("orgs").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in summed)).collect()
    numbers = regions.sparkSession.createDataFrame([(i, s.orgs) for i, s in enumerate(sets)], "set int, orgs array<string>")
    return Tiles(written.join(F.broadcast(numbers), "orgs").drop("orgs"), sets)


def _held(regions: DataFrame, region_org: DataFrame, ordered: DataFrame) -> DataFrame:
    """Adds orgs and rank, each one's priority; both are empty for a region of no organism."""
    own = region_org.join(ordered.select("org", "region_id", F.col("priority").cast("long").alias("rank")), ["org", "region_id"])
    own = own.groupBy("region_id").agg(F.array_sort(F.collect_set(F.struct("org", "rank"))).alias("held"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    out = regions.join(own, "region_id", "left").withColumns({"orgs": F.coalesce("held.org", none("string")), "rank": F.coalesce("held.rank", none("long"))})
    return out.drop("held")


def _of_sets(rows: DataFrame, values: dict[int, tuple], schema: str) -> DataFrame:
    """rows of the sets in ``values``, with these as columns."""
    known = rows.sparkSession.createDataFrame([(i, *v) for i, v in values.items()], f"set int, {schema}")
    return rows.join(F.broadcast(known), "set")


def _sums(rows: DataFrame) -> dict[int, int]:
    """The probes of each set's regions."""
    return {r.set: int(r.n) for r in rows.groupBy("set").agg(F.sum("probes").alias("n")).collect()}


def _per_org(sets: list[Row], numbers: dict[int, int]) -> Counter:
    """The sum of its sets' numbers for each organism."""
    out: Counter = Counter()
    for i, n in numbers.items():
        for o in sets[i].orgs:
            out[o] += n
    return out


def _rank(rows: DataFrame, which: Column) -> Column:
    """The rank of regions with one of their organisms."""
    return F.get("rank", which) if isinstance(rows.schema["rank"].dataType, ArrayType) else F.col("rank")


# ---------------------------------------------------------------- the scan


def _groups(sets: list[list[str]]) -> dict[str, str]:
    """Organism -> the first of all that are joined to it by sets."""
    above: dict[str, str] = {}

    def top(x: str) -> str:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for orgs in sets:
        for other in orgs[1:]:
            a, b = sorted((top(orgs[0]), top(other)))
            above[b] = a
    return {x: top(x) for x in above}


def _scan(tiles: Tiles, turns: dict[str, int], chosen: list[int], state: dict[str, list[int]], step: Callable, probe: int, label: str) -> DataFrame:
    """The regions of the sets ``chosen`` as ``step`` leaves them, written: ROW. They go by the first turn of their organisms, and within it from the last in that organism's order to the first.

    step(len, begin, n_lo, n_hi, density, probes, the state of its organisms, probe) returns (len, begin, density, probes) and changes the state. Groups of organisms are scanned apart.
    """
    orgs = {i: tiles.sets[i].orgs for i in chosen}
    above, sizes = _groups(list(orgs.values())), Counter()
    group = {i: above.get(own[0], own[0]) for i, own in orgs.items()}
    for i, g in group.items():
        sizes[g] += tiles.sets[i].n
    loads = [(0, t) for t in range(max(1, min(len(sizes), 4 * tiles.rows.sparkSession.sparkContext.defaultParallelism)))]
    task = {}
    for g, n in sizes.most_common():  # the largest first, to the task that has least
        held, t = loads[0]
        heapreplace(loads, (held + n, t))
        task[g] = t
    turn = {i: min((turns[o], k) for k, o in enumerate(own) if o in turns) for i, own in orgs.items()}
    rows = _of_sets(tiles.rows, {i: (task[group[i]], *turn[i]) for i in chosen}, "task int, turn int, which int")
    numbers = ["len", "begin", "n_lo", "n_hi", "density", "probes"]
    none = F.lit(0).cast("long")
    met = rows.select("task", "turn", _rank(rows, F.col("which")).alias("at"), F.col("region_id").cast("string").alias("region_id"), "set", "rank", *(F.col(c).cast("long").alias(c) if c in rows.columns else none.alias(c) for c in numbers))
    dealt = met.repartitionById(len(loads), "task").sortWithinPartitions("turn", F.desc("at"), F.desc("region_id")).drop("task", "turn", "at")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = {}, {}
        for batch in batches:
            out = []
            for i, *row in zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in (batch.column(x) for x in ("set", *numbers)))):
                states = held.get(i)
                if states is None:
                    states = held[i] = [now.setdefault(o, list(state[o])) for o in orgs[i]]
                out.append(step(*row, states, probe))
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, t) for x, t in zip(zip(*out), kinds))], ROW)

    rank = rows.schema["rank"].dataType.simpleString()
    return materialize(dealt.mapInArrow(run, f"region_id string, set int, rank {rank}, len long, begin long, density int, probes long"), label)


# ---------------------------------------------------------------- classes


def classes(sets: list[Row], budget: int) -> tuple[Fraction, dict[str, str]]:
    """The ideal number of probes per organism, and each organism's class: Max where even the densest tiling stays below the ideal, Min where the thinnest is above, else Med.

    The ideal is what is left of the budget over the Med organisms. Regions of Max organisms count at their most, else those of Min organisms at their least, each region
    once, however many organisms have it. Classes are found anew for each ideal until none is left in Med, all are, or an ideal comes back. An ideal of 0 or less makes all Min.
    """
    least, most = (_per_org(sets, {i: int(s[c]) for i, s in enumerate(sets)}) for c in ("n_lo", "n_hi"))
    kinds, med, left, seen = dict.fromkeys(least, "Med"), budget, len(least), set()
    ideal = Fraction(0)
    while left:
        ideal = Fraction(med, left)
        kinds = {o: "Max" if most[o] < ideal else "Min" if least[o] > ideal else "Med" for o in least}
        own = [{kinds[o] for o in s.orgs} for s in sets]
        fixed = sum(int(s.n_hi) if "Max" in k else int(s.n_lo) if "Min" in k else 0 for s, k in zip(sets, own))
        med, left = budget - fixed, sum(k == "Med" for k in kinds.values())
        if left == len(kinds) or ideal in seen:
            break
        seen.add(ideal)
    return ideal, kinds


def classify(bounded: DataFrame, region_org: DataFrame, budget: int) -> tuple[Fraction, dict[str, str]]:
    """classes for bounded(region_id, n_lo, n_hi) of the organisms in region_org."""
    orgs = region_org.groupBy("region_id").agg(F.array_sort(F.collect_set("org")).alias("orgs"))
    met = bounded.select("region_id", "n_lo", "n_hi").join(orgs, "region_id")
    return classes(met.groupBy("orgs").agg(F.sum("n_lo").alias("n_lo"), F.sum("n_hi").alias("n_hi")).collect(), budget)


# ---------------------------------------------------------------- target densities


def _weighted(length: int, begin: int, lo: int, hi: int, _density: int, _probes: int, states: list[list[int]], probe: int) -> tuple[int, int, int, int]:
    """A region's density from what its organisms still lack: each organism's weight is lack / (lack + most that its open regions can give); the highest counts."""
    lack, most = 0, 1
    for d, p, _ in states:
        if d > 0 and d * (lack + most) > lack * (d + p):
            lack, most = d, p
    density = density_for(length, most * lo + lack * hi, lack + most, probe)
    baits = baits_of(length, density, probe)
    for s in states:
        s[0] -= baits * s[2]
        s[1] -= hi * s[2]
    return length, begin, density, baits


def densities(tiles: Tiles, kinds: dict[str, str], budget: int, probe: int) -> Tiles:
    """Tiles with lo, hi, n_lo, n_hi -> ROW: each region's density and probes; regions of no organism are left out.

    Regions of Max organisms get their most, others of no Med organism their least. What is left of the budget, over the Med organisms, is
    their ideal. Med organisms take turns, those of fewest regions first; in a turn the organism's open regions go from the last in its order (the most shared)
    to the first, and each decision changes what its organisms lack and can still get.
    """
    sets = tiles.sets
    regions = _per_org(sets, {i: s.n for i, s in enumerate(sets)})
    own = {i: {kinds[o] for o in s.orgs if o in kinds} for i, s in enumerate(sets)}
    fixed = {i: "Max" in k for i, k in own.items() if k and ("Max" in k or "Med" not in k)}
    open_ = [i for i, k in own.items() if "Med" in k and "Max" not in k]
    turns = {o: t for t, o in enumerate(sorted(regions, key=lambda o: (regions[o], o))) if kinds.get(o) == "Med"}
    done = _of_sets(tiles.rows, {i: (most,) for i, most in fixed.items()}, "most boolean")
    pick = lambda c, kind: F.when(F.col("most"), F.col(f"{c}hi")).otherwise(F.col(f"{c}lo")).cast(kind)
    done = done.select("region_id", "set", "rank", F.col("len").cast("long").alias("len"), F.col("begin").cast("long").alias("begin"), pick("", "int").alias("density"), pick("n_", "long").alias("probes"))
    given = {i: int(sets[i].n_hi if most else sets[i].n_lo) for i, most in fixed.items()}
    n, left = sum(k == "Med" for k in kinds.values()), budget - sum(given.values())

    def states(rest: list[int]) -> dict[str, list[int]]:
        """Per organism what it lacks and what its open regions can give at most, both times n, and n."""
        had, can = _per_org(sets, given), _per_org(sets, {i: int(sets[i].n_hi) for i in rest})
        return {o: [left - had[o] * n, can[o] * n, n] for o in regions}

    parts, several = [done], [i for i in open_ if len(sets[i].orgs) > 1]
    if several:
        parts.append(_scan(tiles, turns, several, states(open_), _weighted, probe, "shared"))
        given |= _sums(parts[-1])
    # no other organism depends on regions of one organism: these come last in its turn
    private = [i for i in open_ if len(sets[i].orgs) == 1]
    if private:
        parts.append(_scan(tiles, turns, private, states(private), _weighted, probe, "private"))
        given |= _sums(parts[-1])
    return Tiles(reduce(DataFrame.unionByName, parts), sets, given)


def target_densities(bounded: DataFrame, region_org: DataFrame, kinds: dict[str, str], ordered: DataFrame, budget: int, probe: int) -> DataFrame:
    """bounded(region_id, len, lo, hi, n_lo, n_hi), ordered(org, region_id, priority) -> bounded with density and probes, as ``densities`` finds them."""
    if "begin" not in bounded.columns:
        bounded = bounded.withColumn("begin", F.lit(0).cast("long"))
    rows = _held(bounded.select("region_id", "len", "begin", "lo", "hi", "n_lo", "n_hi"), region_org, ordered)
    found = densities(by_sets(rows, "n_lo", "n_hi"), kinds, budget, probe).rows
    return materialize(bounded.join(found.select("region_id", "density", "probes"), "region_id"), "targets")


# ---------------------------------------------------------------- trimming


def allowances(counts: dict[str, int], excess: int, floor: int) -> dict[str, int]:
    """How many probes each organism gives up: always one of the richest (the first by name of equal ones), until ``excess`` are given or none has more than ``floor``."""
    low, high = floor, max([floor, *counts.values()])
    while low < high:  # the lowest level to which all richer ones may go
        level = (low + high) // 2
        if sum(max(0, c - level) for c in counts.values()) <= excess:
            high = level
        else:
            low = level + 1
    out = {o: max(0, c - low) for o, c in counts.items()}
    rest = excess - sum(out.values()) if low > floor else 0
    for o in sorted(o for o, c in counts.items() if c >= low)[:rest]:
        out[o] += 1
    return out


def _given_up(length: int, begin: int, _lo: int, _hi: int, density: int, probes: int, states: list[list[int]], probe: int) -> tuple[int, int, int, int]:
    """A region loses as many probes as all its organisms may still give up; 0 probes tell that it goes."""
    give = min(probes, *(s[0] for s in states))
    if give <= 0:
        return length, begin, density, probes
    for s in states:
        s[0] -= give
    if give == probes:
        return length, begin, density, 0
    return shorten(length, begin, density, probes - give, probe)


def _cut_private(rows: DataFrame, given: dict[int, int], probe: int) -> tuple[DataFrame, list[DataFrame]]:
    """What is left of regions of one organism whose sets give up so many probes, and the written tables it reads.

    An organism's last regions go whole and one is shortened, so the last rank that is touched is found from the sums of ranks, and only regions of that rank are looked at one by one.
    """
    spark, rank = rows.sparkSession, _rank(rows, F.lit(0))
    w = lambda *order: W.partitionBy("set").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    steps = _of_sets(rows, {i: (n,) for i, n in given.items()}, "may long").groupBy("set", "may", rank.alias("at")).agg(F.sum("probes").alias("n"))
    before = steps.withColumn("before", F.sum("n").over(w(F.desc("at"))) - F.col("n")).where("before < may")
    ends = {r.set: (r.at, r.may - r.before) for r in before.groupBy("set", "may").agg(F.min("at").alias("at"), F.max("before").alias("before")).collect()}
    mine = _of_sets(rows, ends, "at long, rest long")
    edge = mine.where(rank == F.col("at")).withColumn("left", F.sum("probes").over(w(F.desc("region_id"))) - F.col("rest")).where("left > 0")
    edge = materialize(edge, "edge")  # of each organism at most one region has more probes than are left to it
    short = [(r.region_id, r.set, r.rank, *shorten(r.len, r.begin, r.density, r.left, probe)) for r in edge.where("left < probes").collect()]
    whole = [mine.where(rank < F.col("at")), edge.where("left >= probes")]
    return reduce(DataFrame.unionByName, [*(x.select(*ROW) for x in whole), spark.createDataFrame(short, rows.select(*ROW).schema)]), [edge]


def trimmed(tiles: Tiles, budget: int, floor: int, probe: int) -> DataFrame:
    """ROW -> what stays of it: shorter len, begin (bases cut off before), density, probes.

    The richest organisms give up probes first, though none below ``floor``. An organism gives them up from its last region to its first: a region is shortened about
    its middle, or goes; what it loses counts for all its organisms, so it loses no more than the one may that can give up least. As sharing keeps some
    organisms from giving all they might, this is done again until the budget is met or nothing moves.
    """
    now, sets, held, made = tiles.rows, tiles.sets, tiles.probes, []
    while True:
        held = held if held is not None else _sums(now)
        counts, total = _per_org(sets, held), sum(held.values())
        given = allowances(counts, total - budget, floor) if total > budget else {}
        if not any(given.values()):
            return now
        turns = {o: i for i, o in enumerate(sorted(given, key=lambda o: (-given[o], o)))}
        may = [i for i in held if sets[i].orgs and all(given[o] for o in sets[i].orgs)]
        several, parts, read = [i for i in may if len(sets[i].orgs) > 1], [], []
        if several:
            shared = _scan(Tiles(now, sets), turns, several, {o: [n] for o, n in given.items()}, _given_up, probe, "shared-cut")
            left = _sums(shared)
            gone = _per_org(sets, {i: held[i] - left[i] for i in several})
            parts, read = [shared.where("probes > 0")], [shared]
        else:
            gone = Counter()
        private = {i: given[o] - gone[o] for i in may if len(sets[i].orgs) == 1 for o in sets[i].orgs if given[o] > gone[o]}
        if not private and not any(gone.values()):
            return now
        if private:
            kept, written = _cut_private(now, private, probe)
            parts, read = [*parts, kept], [*read, *written]
        rest = [(i,) for i in held if i not in private and i not in several]
        known = now.sparkSession.createDataFrame(rest, "set int")
        parts.append(now.join(F.broadcast(known), "set").select(*ROW))
        now = materialize(reduce(DataFrame.unionByName, parts), "trimmed")
        discard(*read, *made)
        held, made = None, [now]


def trim(tiled: DataFrame, region_org: DataFrame, ordered: DataFrame, budget: int, floor: int, probe: int) -> DataFrame:
    """tiled(region_id, len, density, probes, ...), ordered(org, region_id, priority) -> what ``trimmed`` leaves of it, with its other columns."""
    now = tiled if "begin" in tiled.columns else tiled.withColumn("begin", F.lit(0).cast("long"))
    if int(now.agg(F.sum("probes")).first()[0] or 0) <= budget:
        return now
    kinds = {"len": "long", "begin": "long", "density": "int", "probes": "long"}
    rows = _held(now.select("region_id", *(F.col(c).cast(k).alias(c) for c, k in kinds.items())), region_org, ordered)
    left = trimmed(by_sets(rows), budget, floor, probe)
    return now.drop(*kinds).join(left.select("region_id", *kinds), "region_id").select(*now.columns)


# ---------------------------------------------------------------- caps


def best_cap(needs: DataFrame, budget: int, low: int = 1) -> int:
    """needs(need, probes): the largest cap for which the probes of all rows with need <= cap fit the budget; at least ``low``, at most the greatest need. One pass makes the total of every cap."""
    steps = needs.groupBy("need").agg(F.sum("probes").alias("n"))
    upto = steps.select("need", F.sum("n").over(W.orderBy("need")).alias("total"))
    r = upto.agg(F.max("need").alias("most"), F.min(F.when(F.col("total") > budget, F.col("need"))).alias("over")).first()
    return max(low, int(r.over) - 1 if r.over is not None else int(r.most or low))


def tune_regions(ordered: DataFrame, tiled: DataFrame, budget: int) -> int:
    """The most regions per organism at which the probes of all regions fit the budget; a region stays if any of its organisms has it among so many."""
    return best_cap(tiled.select("region_id", "probes").join(ordered.groupBy("region_id").agg(F.min("priority").alias("need")), "region_id"), budget)
