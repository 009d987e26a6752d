"""Seeds, and repeats in tandem that meet as runs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tilewright.operators import homology

FLIP = str.maketrans("ACGT", "TGCA")


def slow_hits(a, b, seeds):
    out = Counter()
    for i, x in a.items():
        for j, raw in b.items():
            for strand, y in (("+", raw), ("-", raw.translate(FLIP)[::-1])):
                for seed in seeds:
                    ones = [k for k, c in enumerate(seed) if c == "1"]
                    under = lambda t: [(p + 1, "".join(t[p + k] for k in ones)) for p in range(len(t) - len(seed) + 1)]
                    at = {}
                    for q, key in under(y):
                        at.setdefault(key, []).append(q)
                    for p, key in under(x):
                        if re.fullmatch("[ACGT]+", key):
                            out.update((i, j, strand, p - q) for q in at.get(key, ()))
    return out


def repetitive(rng, n):
    """Random bases with homopolymers, repeats of two to five bases and letters beyond ACGT."""
    out = ""
    while len(out) < n:
        kind = rng.randrange(5)
        unit = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 6)))
        out += "".join(rng.choice("ACGT") for _ in range(30)) if kind == 0 else rng.choice(["A", "AC", "T"]) * rng.randrange(5, 40) if kind < 3 else unit * rng.randrange(3, 20) if kind == 3 else "N"
    return out[:n]


@pytest.mark.parametrize("seeds", [["1" * 8], ["1101011", "11100011", "1111"]])
def test_hits_equal_all_pairs_of_places(spark, seeds):
    rng = random.Random(len(seeds))
    a, b = ({f"{k}{i}": repetitive(rng, rng.randrange(50, 350)) for i in range(4)} for k in "ab")
    a |= {"none": "", "short": "ACG", "poly": "A" * 200}
    b |= {"poly": "T" * 150 + "G" + "A" * 90}
    got = homology.spaced_hits(*(spark.createDataFrame(list(x.items()), "id string, seq string") for x in (a, b)), seeds)
    assert Counter({(r.a_id, r.b_id, r.strand, r.diagonal): r.seeds for r in got.collect()}) == slow_hits(a, b, seeds)


def test_runs_stand_for_their_places():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pos = np.flatnonzero(rng.random(120) < rng.choice([0.3, 0.9, 1.0]))
        key = rng.integers(0, rng.choice([1, 2, 5]), len(pos)) if rng.random() < 0.5 else pos % rng.integers(1, 7)
        got = Counter()
        for k, p, step, n in zip(*(x.tolist() for x in homology.tandem_runs(key, pos))):
            assert n == 1 and not step or n >= homology.TANDEM and step > 0
            got.update((k, p + i * step) for i in range(n))
        assert got == Counter(zip(key.tolist(), pos.tolist()))


def test_long_repeats_take_linear_room(spark):
    """100,000 equal bases against as many: 10 ** 10 pairs of places lie on 200,000 diagonals."""
    n = 100_000
    rng = random.Random(4)
    noise = "".join(rng.choice("ACGT") for _ in range(200_000))
    a = spark.createDataFrame([("a", noise + "A" * n + "C")], "id string, seq string")
    b = spark.createDataFrame([("b", "G" + "A" * n)], "id string, seq string")
    got = homology.seed_hits(a, b, 14).where("strand = '+'").groupBy().agg({"seeds": "sum", "*": "count"}).first()
    places = n - 13
    assert got["sum(seeds)"] >= places * places and got["count(1)"] <= 2 * places + 1000


def test_seeds_find_similar_windows():
    same = homology.simulated_windows(np.random.default_rng(77), 4000, 75, 57)
    hit = np.logical_or.reduce([homology.seed_hit(same, s) for s in homology.SEEDS])
    assert hit.mean() > 0.999 and {s.count("1") for s in homology.SEEDS} == {11}
    assert homology.search_seeds(1, 11, 28, windows=300, tries=20) == homology.search_seeds(1, 11, 28, windows=300, tries=20)
