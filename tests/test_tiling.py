"""Classes, target densities and trimming against slow versions that follow the rules region by region."""

import random
from fractions import Fraction
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from tilewright.operators import select, tiling

L = 20


def spacing(n, d):
    return L if d == 1 else max(1, floor((n - L) / (d - 1)) if n < 2 * L else floor((L - 1) / (d - 1)))


def baits(n, d):
    return ceil((n - L + 1) / spacing(n, d))


def bounds(n, least):
    hi = L if n >= 2 * L - 1 else n - L + 1
    return min(hi, least), hi


class Slow:
    """regions: id -> length; orgs: id -> organisms. Everything is recounted at each step."""

    def __init__(self, lengths, orgs, least):
        self.len, self.orgs, self.least = dict(lengths), orgs, least
        self.names = sorted({o for x in orgs.values() for o in x})
        order = lambda r: (len(orgs[r]), lengths[r], r)
        self.order = {o: sorted((r for r in lengths if o in orgs[r]), key=order) for o in self.names}

    def lo(self, r):
        return baits(self.len[r], bounds(self.len[r], self.least)[0])

    def hi(self, r):
        return baits(self.len[r], bounds(self.len[r], self.least)[1])

    def classes(self, budget):
        med, n, seen, kinds = budget, len(self.names), [], {}
        while n:
            ideal = Fraction(med, n)
            kinds = {}
            for o in self.names:
                least, most = (sum(map(f, self.order[o])) for f in (self.lo, self.hi))
                kinds[o] = "Max" if most < ideal else "Min" if least > ideal else "Med"
            med = budget
            for r in self.len:
                own = {kinds[o] for o in self.orgs[r]}
                med -= self.hi(r) if "Max" in own else self.lo(r) if "Min" in own else 0
            n = list(kinds.values()).count("Med")
            if n == len(kinds) or ideal in seen:
                break
            seen.append(ideal)
        return kinds

    def targets(self, kinds, budget):
        target = {}
        for r in self.len:
            own = {kinds[o] for o in self.orgs[r]}
            if "Max" in own or "Med" not in own:
                target[r] = bounds(self.len[r], self.least)["Max" in own]
        left = budget - sum(baits(self.len[r], d) for r, d in target.items())
        n = list(kinds.values()).count("Med")
        for o in sorted(self.names, key=lambda o: (len(self.order[o]), o)):
            if kinds[o] != "Med":
                continue
            for r in reversed(self.order[o]):
                if r in target:
                    continue
                weight = Fraction(0)
                for other in self.orgs[r]:
                    lack = Fraction(left, n) - sum(baits(self.len[x], target[x]) for x in self.order[other] if x in target)
                    can = sum(self.hi(x) for x in self.order[other] if x not in target)
                    if lack > 0:
                        weight = max(weight, lack / (lack + can))
                wanted, k = (1 - weight) * self.lo(r) + weight * self.hi(r), self.len[r]
                if wanted + 1 == ceil(Fraction(k + 1, L)):
                    target[r] = 1
                elif k < 2 * L:
                    target[r] = floor(wanted * (k - L) / (k - L + 1)) + 1
                else:
                    target[r] = floor(wanted * (L - 1) / (k - L + 1)) + 1
        return target

    def trim(self, density, budget, least):
        size, begin, density = dict(self.len), dict.fromkeys(self.len, 0), dict(density)
        while True:
            count = {r: baits(size[r], density[r]) for r in size}
            held = {o: sum(count[r] for r in self.order[o] if r in size) for o in self.names if any(r in size for r in self.order[o])}
            excess, given = sum(count.values()) - budget, dict.fromkeys(held, 0)
            for _ in range(excess):  # a queue: the richest gives one up
                rich = min((o for o in held if held[o] - given[o] > least), key=lambda o: (given[o] - held[o], o), default=None)
                if rich is None:
                    break
                given[rich] += 1
            moved = False
            for o in sorted(given, key=lambda o: (-given[o], o)):
                for r in reversed(self.order[o]):
                    if r not in size or not given[o]:
                        continue
                    give = min([count[r], *(given[x] for x in self.orgs[r])])
                    if not give:
                        continue
                    moved = True
                    for x in self.orgs[r]:
                        given[x] -= give
                    wanted = count[r] - give
                    if not wanted:
                        del size[r]
                        continue
                    was = size[r]
                    while baits(size[r], density[r]) > wanted:
                        size[r] = wanted * spacing(size[r], density[r]) + L - 1
                        density[r] = min(density[r], bounds(size[r], 1)[1])
                    begin[r] += (was - size[r]) // 2
                    count[r] = 0  # met once a pass
            if not moved:
                return {r: (size[r], begin[r], density[r], baits(size[r], density[r])) for r in size}


def made(seed, n=60, organisms=7, shared=0.5):
    rng = random.Random(seed)
    names = [f"o{i}" for i in range(organisms)]
    lengths = {f"r{i:03d}": rng.choice([L, L + 1, 2 * L - 1, 2 * L, rng.randrange(L, 12 * L)]) for i in range(n)}
    orgs = {r: sorted(rng.sample(names, rng.randrange(2, 5))) if rng.random() < shared else [rng.choice(names[: 1 + i % organisms])] for i, r in enumerate(lengths)}
    return lengths, orgs


def frames(spark, lengths, orgs):
    regions = spark.createDataFrame([(r, n, "x") for r, n in lengths.items()], "region_id string, len int, at string")
    return regions, spark.createDataFrame([(r, o) for r, own in orgs.items() for o in own], "region_id string, org string").repartition(3)


@pytest.mark.parametrize("seed, shared, part", [(1, 0.5, 0.5), (3, 1.0, 0.3)])
def test_equals_slow_versions(spark, seed, shared, part):
    lengths, orgs = made(seed, shared=shared)
    slow = Slow(lengths, orgs, 3)
    regions, region_org = frames(spark, lengths, orgs)
    bounded = select.with_bounds(regions, L, 3)
    budget = int(part * sum(slow.hi(r) for r in lengths))
    ideal, kinds = tiling.classify(bounded, region_org, budget)
    assert kinds == slow.classes(budget)
    ordered = select.priority_order(region_org, bounded)
    tiled = tiling.target_densities(bounded, region_org, kinds, ordered, budget, L)
    want = slow.targets(kinds, budget)
    assert {r.region_id: r.density for r in tiled.collect()} == want and all(r.probes == baits(r.len, r.density) for r in tiled.collect())
    whole = sum(baits(lengths[r], d) for r, d in want.items())
    for goal, floor_ in ((whole, 5), (int(0.6 * whole), 5)):
        left = tiling.trim(tiled, region_org, ordered, goal, floor_, L).collect()
        assert {r.region_id: (r.len, r.begin, r.density, r.probes) for r in left} == slow.trim(want, goal, floor_)
        assert all(r.at == "x" and r.begin + r.len <= lengths[r.region_id] for r in left)


def test_all_classes_and_odd_budgets(spark):
    lengths = {"a": 400, "b": 420, "c": 60, "d": 25, "e": 200, "f": 210, "g": 900}
    orgs = {"a": ["rich"], "b": ["rich", "mid"], "c": ["mid", "poor"], "d": ["poor"], "e": ["mid"], "f": ["mid2"], "g": ["rich"]}
    slow = Slow(lengths, orgs, 3)
    regions, region_org = frames(spark, lengths, orgs)
    bounded, seen = select.with_bounds(regions, L, 3), set()
    for budget in (0, 40, 300, 1500):
        _, kinds = tiling.classify(bounded, region_org, budget)
        assert kinds == slow.classes(budget), budget
        seen |= set(kinds.values())
    assert seen == {"Min", "Med", "Max"}
    none = bounded.where("false")
    assert tiling.classify(none, region_org.where("false"), 10)[1] == {}
    assert tiling.trim(none.withColumns({"density": F.lit(1), "probes": F.lit(1)}), region_org, select.priority_order(region_org, bounded), 0, 3, L).count() == 0


def test_allowances():
    rng = random.Random(3)
    for _ in range(200):
        counts = {f"o{i}": rng.randrange(0, 40) for i in range(rng.randrange(1, 8))}
        excess, least = rng.randrange(0, 120), rng.randrange(0, 12)
        want = dict.fromkeys(counts, 0)
        for _ in range(excess):
            rich = min((o for o in counts if counts[o] - want[o] > least), key=lambda o: (want[o] - counts[o], o), default=None)
            if rich is None:
                break
            want[rich] += 1
        assert tiling.allowances(counts, excess, least) == want


def test_shortened_regions_keep_their_middle():
    for length in range(L, 8 * L):
        for density in {1, 2, 5, tiling.densest(length, L)}:
            if density > tiling.densest(length, L):
                continue
            whole = baits(length, density)
            assert whole == tiling.baits_of(length, density, L)
            for target in range(1, whole):
                n, begin, d, left = tiling.shorten(length, 0, density, target, L)
                assert 1 <= left <= target and L <= n and 0 <= begin and abs((length - n) - 2 * begin) <= 1 and d <= density


@pytest.mark.parametrize("budget", [7, 200])
def test_caps_in_one_pass(spark, budget):
    lengths, orgs = made(9)
    regions, region_org = frames(spark, lengths, orgs)
    tiled = select.with_bounds(regions, L, 3).withColumn("probes", F.col("n_lo"))
    ordered = select.priority_order(region_org, regions)
    rows = [(r.org, r.region_id, r.priority) for r in ordered.collect()]
    sizes = {r.region_id: r.probes for r in tiled.collect()}
    total = lambda cap: sum(sizes[x] for x in {r for _, r, p in rows if p <= cap})
    most = max(p for *_, p in rows)
    assert tiling.tune_regions(ordered, tiled, budget) == max([1, *(c for c in range(1, most + 1) if total(c) <= budget and c <= max(min(p for o, x, p in rows if x == r) for r in sizes))])
    least = ordered.groupBy("region_id").agg(F.min("priority").alias("priority"))
    needs = select.needed_baits(tiled.join(least, "region_id"), region_org)
    known = [(r.need, r.probes) for r in needs.collect()]
    fits = [c for c in range(1, max(n for n, _ in known) + 1) if sum(p for n, p in known if n <= c) <= budget]
    assert tiling.best_cap(needs, budget) == max([1, *fits])


def test_layout_does_not_matter(spark):
    lengths, orgs = made(11, n=40)
    regions, region_org = frames(spark, lengths, orgs)
    results = set()
    for n in (1, 5):
        bounded = select.with_bounds(regions.repartition(n), L, 3)
        ordered = select.priority_order(region_org.repartition(n), bounded)
        _, kinds = tiling.classify(bounded, region_org.repartition(n), 500)
        tiled = tiling.target_densities(bounded, region_org, kinds, ordered, 500, L)
        results.add(tuple(sorted((r.region_id, r.len, r.begin, r.density) for r in tiling.trim(tiled, region_org, ordered, 300, 4, L).collect())))
    assert len(results) == 1


@pytest.mark.parametrize("sizes", [(40,), (25, 60, 60, 61, 200)])
def test_regions_of_one_organism_are_trimmed_by_sums(spark, monkeypatch, sizes):
    """No region of a single organism is scanned for it, and equal ranks go by region_id."""
    lengths = {f"r{i:03d}": sizes[i % len(sizes)] for i in range(50)}
    orgs = {r: [f"o{i % 3 if i < 40 else 0}"] for i, r in enumerate(lengths)}
    slow, density = Slow(lengths, orgs, 3), {r: 1 + i % 5 for i, r in enumerate(lengths)}
    density = {r: min(d, tiling.densest(lengths[r], L)) for r, d in density.items()}
    regions, region_org = frames(spark, lengths, orgs)
    known = spark.createDataFrame([(r, d, baits(lengths[r], d)) for r, d in density.items()], "region_id string, density int, probes long")
    tiled = regions.join(known, "region_id")
    whole = sum(baits(lengths[r], d) for r, d in density.items())
    rows = tiled.join(region_org, "region_id").select("region_id", F.array("org").alias("orgs"), F.col("len").cast("long").alias("rank"), F.col("len").cast("long").alias("len"), F.lit(0).cast("long").alias("begin"), "density", "probes")
    ordered = select.priority_order(region_org, regions)
    monkeypatch.setattr(tiling, "_scan", None)
    for goal, least in ((whole - 1, 2), (whole // 2, 2), (0, 0), (0, 9)):
        want = slow.trim(density, goal, least)
        for left in (tiling.trim(tiled, region_org, ordered, goal, least, L), tiling.trimmed(tiling.by_sets(rows), goal, least, L)):
            assert {r.region_id: (r.len, r.begin, r.density, r.probes) for r in left.collect()} == want


def test_organisms_have_tasks_of_their_own(spark):
    lengths, orgs = made(5, n=80, organisms=4, shared=0.0)
    regions, region_org = frames(spark, lengths, orgs)
    slow, held = Slow(lengths, orgs, 3), select.with_bounds(regions, L, 3).join(region_org, "region_id")
    rows = held.select("region_id", F.array("org").alias("orgs"), F.col("len").cast("long").alias("rank"), "len", F.lit(0).alias("begin"), "lo", "hi", "n_lo", "n_hi")
    tiles = tiling.by_sets(rows, "n_lo", "n_hi")
    budget = sum(map(slow.hi, lengths)) // 2
    kinds = dict.fromkeys(slow.names, "Med")
    found = tiling.densities(tiles, kinds, budget, L)
    assert {r.region_id: r.density for r in found.rows.collect()} == slow.targets(kinds, budget)
    files = found.rows.where("set >= 0").withColumn("file", F.input_file_name()).groupBy("file").agg(F.countDistinct("set").alias("n")).collect()
    assert [r.n for r in files] == [1] * 4
    assert found.probes == {r.set: r.n for r in found.rows.groupBy("set").agg(F.sum("probes").alias("n")).collect()}
