"""Operators on small invented rows with answers worked out by hand or by brute force."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.functions import cigar, seq as S
from tilewright.operators import cluster, homology, identify, intervals, select, targets, tree
from tilewright.params import Params

FLIP = str.maketrans("ACGT", "TGCA")


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first().x


# ---------------------------------------------------------------- sequences


def test_sequence_functions(spark):
    rng = random.Random(0)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (1, 14, 15, 74, 75, 700, 1500)]
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    assert {r.id: r.x for r in df.select("id", S.revcomp(S.revcomp(F.col("seq"))).alias("x")).collect()} == dict(enumerate(seqs))
    got = defaultdict(dict)
    for r in S.explode_windows(df, 75, first=3).collect():
        got[r.id][r.pos] = r.window
    assert got == {i: {p: s[p - 1 : p + 74] for p in range(3, len(s) - 73)} for i, s in enumerate(seqs) if len(s) >= 77}
    assert one(spark, S.pack2bit(F.col("s")), s="ACGTT") == 0b0001101111
    assert one(spark, S.translate_codons(F.col("s")), s="ATGGCCTAANNNAA") == "MA*X"
    assert one(spark, S.wrap(F.col("s"), 4), s="ACGTACGTAC") == "ACGT\nACGT\nAC"
    assert one(spark, S.wrap(F.col("s"), 5), s="ACGTACGTAC") == "ACGTA\nCGTAC"
    runs = S.segments_of_acgt(spark.createDataFrame([(1, "nnACGTnnNacgXtt")], "id int, seq string")).collect()
    assert [(r.seq, r.offset) for r in runs] == [("ACGT", 2), ("ACG", 9), ("TT", 13)]


def test_cigar(spark):
    build = lambda q, r: one(spark, cigar.build(F.col("q"), F.col("r")), q=q, r=r)
    assert build("AC-GTA--", "ACTG-T--") == "2=1D1=1I1X"
    assert one(spark, cigar.simplify(F.col("c")), c="2=3X1N2D4S1I5H6P2M") == "5M3D5I2M"
    adjust = lambda p, c, g=False: one(spark, cigar.adjust(F.col("p"), F.col("c"), g), p=p, c=c)
    assert [adjust(p, "2=2D1I3=") for p in range(1, 9)] == [1, 2, 2, 2, 4, 5, 6, None]
    assert [adjust(p, "2=2D1I3=", True) for p in (3, 4, 5)] == [3, 3, 4]


# ---------------------------------------------------------------- intervals

SPANS = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), max_size=12)


@settings(max_examples=12, deadline=None)
@given(SPANS)
def test_merge_and_subtract(spark, spans):
    df = spark.createDataFrame([("k", s, s + n) for s, n in spans], "k string, s int, e int")
    covered = {x for s, n in spans for x in range(s, s + n)}
    merged = sorted((r.s, r.e) for r in intervals.merge_intervals(df, ["k"]).collect())
    assert {x for s, e in merged for x in range(s, e)} == covered and all(a[1] < b[0] for a, b in zip(merged, merged[1:]))
    again = spark.createDataFrame([("k", s, e) for s, e in merged], "k string, s int, e int")
    assert sorted((r.s, r.e) for r in intervals.merge_intervals(again, ["k"]).collect()) == merged
    whole = spark.createDataFrame([("k", 5, 35), ("none", 0, 9)], "k string, s int, e int")
    left = intervals.subtract_intervals(whole, df, ["k"]).collect()
    assert {x for r in left if r.k == "k" for x in range(r.s, r.e)} == set(range(5, 35)) - covered
    assert [(r.s, r.e, r.piece) for r in left if r.k == "none"] == [(0, 9, 0)]


def test_runs_and_lookup(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 3, 7, 9, 10)], "k string, pos int")
    assert sorted((r.pos, r.len, r.n) for r in intervals.collapse_runs(df, ["k"], length=5).collect()) == [(1, 7, 3), (7, 5, 1), (9, 6, 2)]
    values = spark.createDataFrame([(i, v) for i, v in enumerate("xxyyyx")] + [(6, None), (7, None)], "i int, v string").withColumn("k", F.lit(1))
    runs = intervals.run_lengths(values, ["k"], ["i"], "v")
    assert [(r.v, r.n) for r in runs.orderBy("run").collect()] == [("x", 2), ("y", 3), ("x", 1), (None, 2)]
    assert intervals.longest_run(runs, ["k"], "v").first()[1:] == ("y", 3, 2)
    segs = intervals.segment_offsets(spark.createDataFrame([("n", "b", 3), ("n", "a", 2)], "k string, segment string, len int"), ["k"], ["segment"], F.col("len"))
    points = spark.createDataFrame([("n", p) for p in range(7)], "k string, pos long")
    found = {r.pos: (r.segment, r.local) for r in intervals.locate(points, segs, ["k"]).collect()}
    assert found == {0: ("a", 0), 1: ("a", 1), 2: (None, None), 3: ("b", 0), 4: ("b", 1), 5: ("b", 2), 6: (None, None)}


# ---------------------------------------------------------------- identification


def test_unique_windows_by_brute_force(spark):
    rng = random.Random(7)
    core = "".join(rng.choice("ACGT") for _ in range(40))
    seqs = {("a", 1): "".join(rng.choice("ACGT") for _ in range(120)) + core, ("b", 2): core.translate(FLIP)[::-1] + "".join(rng.choice("ACGT") for _ in range(90)), ("a", 3): core + "AC" * 30, ("c", 4): "ACGT"}
    df = spark.createDataFrame([(i, n, s) for (n, i), s in seqs.items()], "id int, node_id string, seq string")
    k, length = 9, 30
    nodes = defaultdict(set)
    for (n, _), s in seqs.items():
        for p in range(len(s) - k + 1):
            nodes[min(s[p : p + k], s[p : p + k].translate(FLIP)[::-1])].add(n)
    want = {(i, p + 1) for (n, i), s in seqs.items() for p in range(len(s) - length + 1) if all(len(nodes[min(w, w.translate(FLIP)[::-1])]) == 1 for w in (s[q : q + k] for q in range(p, p + length - k + 1)))}
    for most in (identify.BROADCAST, 0):
        got = {(r.id, p) for r in identify.unique_starts(df, length, k, broadcast_kmers=most).collect() for p in range(r.s, r.e)}
        assert got == want and any(i == 1 for i, _ in want)


def test_kmer_summary_in_small_pieces(spark):
    from tilewright.operators import kmers

    rng = random.Random(33)
    seqs = ["".join(rng.choice("ACGTN") for _ in range(n)) for n in (0, 3, 4, 30, 200, 900)] + ["A" * 50, None]
    df = spark.createDataFrame([(s, i % 3) for i, s in enumerate(seqs)], "seq string, label long").repartition(3)
    value = lambda w: int("".join(str("ACGT".index(c)) for c in w), 4)
    want = defaultdict(list)
    for i, s in enumerate(seqs):
        for p in range(len(s or "") - 3):
            w = s[p : p + 4]
            if "N" not in w:
                want[value(min(w, w.translate(FLIP)[::-1]))].append(i % 3)
    before, kmers.PIECE = kmers.PIECE, 37
    try:
        got = {r.kmer: (r.least, r.most, r.n) for r in kmers.kmer_summary(df, 4, "n").collect()}
        labels = {r.kmer for r in kmers.kmer_summary(df, 4, "labels").collect()}
    finally:
        kmers.PIECE = before
    assert got == {x: (min(v), max(v), len(v)) for x, v in want.items() if len(v) > 1} and labels == {x for x, v in want.items() if len(set(v)) > 1}


def slow_tm(w):
    table = identify.neighbour_table()
    h, s = map(sum, zip(*(table[w[i : i + 2]] for i in range(len(w) - 1))))
    for end in (w[0], w[-1]):
        dh, ds = identify.END_AT if end in "AT" else identify.END_GC
        h, s = h + dh, s + ds
    return 1000 * h / (s + 1.987 * math.log(1e-6 / 4)) + 12 * math.log10(0.075) - 273.15


def test_melting_temperature(spark):
    rng = random.Random(3)
    s = "".join(rng.choice("ACGT") for _ in range(60))
    df = spark.createDataFrame([(1, s), (2, "ACG"), (3, None)], "id int, seq string")
    got = {r.pos: r.tm for r in identify.window_tm(df, 20, first=4).collect()}
    assert got == pytest.approx({p: slow_tm(s[p - 1 : p + 19]) for p in range(4, 42)})
    assert slow_tm("GC" * 10) > slow_tm("AT" * 10) and slow_tm(s[:20]) == pytest.approx(slow_tm(s[:20].translate(FLIP)[::-1]))


def test_best_interval(spark):
    tms = [("a", 60.005), ("a", 80.0), ("b", 65.0), ("c", 69.99), ("d", 75.0), ("d", 71.5)]
    best = identify.best_tm_interval(spark.createDataFrame(tms, "node_id string, tm double"), 10.0).first()
    bins = [(n, math.floor(t * 100)) for n, t in tms]
    count = lambda low: len({n for n, b in bins if low <= b < low + 1000})
    want = max(range(4000, 9000), key=lambda low: (count(low), low))
    assert (round(best.low * 100), best.nodes) == (want, count(want)) and best.high == pytest.approx(best.low + 10)


def test_gc_bounds_and_middle(spark):
    assert Params().gc_bounds == (22, 53) and Params().max_identity == 56 and Params().first == 26
    df = spark.createDataFrame([(1, "GC" * 4 + "AT" * 6)], "id int, seq string")
    assert {(r.pos, r.gc) for r in identify.gc_windows(df, 10, 4, 7).collect()} == {(p, w.count("G") + w.count("C")) for p in range(1, 12) if 4 <= (w := ("GC" * 4 + "AT" * 6)[p - 1 : p + 9]).count("G") + w.count("C") < 7}
    runs = spark.createDataFrame([("n", 1, 1, 4), ("n", 1, 10, 21), ("n", 2, 5, 6)], "node_id string, id int, s int, e int")
    assert [r.pos for r in identify.middle_of_runs(runs, 2).orderBy("pos").collect()] == [2, 15]


# ---------------------------------------------------------------- homology


def test_seeds_and_identity(spark):
    rng = random.Random(9)
    a = "".join(rng.choice("ACGT") for _ in range(200))
    hit = list(a[50:130])
    for i in (2, 30, 61):
        hit[i] = {"A": "C", "C": "G", "G": "T", "T": "A"}[hit[i]]
    black = {1: "".join(hit), 2: "".join(hit).translate(FLIP)[::-1], 3: "".join(rng.choice("ACGT") for _ in range(80))}
    da, db = (spark.createDataFrame(x, "id int, seq string") for x in ([(7, a)], list(black.items())))
    best = {(r.b_id, r.strand): r for r in homology.diagonal_identity(homology.seed_hits(da, db, 12), da, db, 75).collect() if r.best}
    assert best[1, "+"].diagonal == best[2, "-"].diagonal == 50 and best[1, "+"].best == 73 and best[1, "+"]["at"] == 54
    assert not any(b == 3 for b, _ in best)
    got = {(r.pos, r.key) for r in homology.spaced_keys(spark.createDataFrame([(1, "ACGTNACGA")], "id int, seq string"), ["1101", "11"]).collect()}
    value = lambda w: int("".join(str("ACGT".index(c)) for c in w), 4)
    assert got == {(1, value("ACT")), (3, value("GTA")), (6, value("ACA"))} | {(i + 1, 1 << 56 | value(w)) for i, w in enumerate("ACGTNACGA"[i : i + 2] for i in range(8)) if "N" not in w}


def slow_similar_starts(seqs, length, least):
    """All windows against all windows of other nodes, both strands."""
    out = set()
    for i, (n, s) in seqs.items():
        for p in range(len(s) - length + 1):
            w = s[p : p + length]
            if any(sum(x == y for x, y in zip(w, t[q : q + length])) >= least for m, u in seqs.values() if m != n for t in (u, u.translate(FLIP)[::-1]) for q in range(len(t) - length + 1)):
                out.add((i, p + 1))
    return out


def test_similar_windows_of_other_nodes(spark):
    """Scattered differences, no common 14-mer: only spaced seeds find these; checked against all pairs of windows."""
    rng = random.Random(14)
    base = "".join(rng.choice("ACGT") for _ in range(60))
    far = "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i % 5 == 2 else c for i, c in enumerate(base))
    pad = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = {1: ("x", pad(20) + base + pad(15)), 2: ("y", pad(9) + far), 3: ("z", far.translate(FLIP)[::-1] + pad(30)), 4: ("x", base), 5: ("y", pad(50))}
    df = spark.createDataFrame([(i, n, s) for i, (n, s) in seqs.items()], "id int, node_id string, seq string")
    got = {(r.id, p) for r in homology.similar_starts(df, df, 40, 31).collect() for p in range(r.s, r.e)}
    assert got == slow_similar_starts(seqs, 40, 31) and {i for i, _ in got} == {1, 2, 3, 4}


def slow_dust(text, window, threshold):
    """Bases under perfect intervals, from the scores of all intervals."""
    score = {}
    for i in range(len(text) - 3):
        counts, pairs = Counter(), 0
        for j in range(i, min(len(text) - 2, i + window - 2)):
            t = text[j : j + 3]
            if set(t) - set("ACGT"):
                break
            pairs += counts[t]
            counts[t] += 1
            if j > i:
                score[i, j] = Fraction(pairs, j - i)
    out = set()
    for (i, j), x in score.items():
        if 10 * x > threshold and all(score[a, b] <= x for a in range(i, j) for b in range(a + 1, j + 1)):
            out |= set(range(i + 1, j + 4))
    return out


def test_dust_and_dimers_by_brute_force(spark):
    rng = random.Random(15)
    seqs = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 90))) for letters in ("ACGT", "AC", "A", "AAAT", "ACGTN", "AAAAAAAN") for _ in range(6)]
    seqs += ["ACGTTGCATG" * 3 + "AC" * 12 + "GGTCATTTTTTTTTTTTCA", "GATTACA" * 9]
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    for window, threshold in ((20, 12.0), (30, 20.0)):
        masked, spans = defaultdict(set), defaultdict(list)
        for r in homology.dust_intervals(df, window, threshold).collect():
            masked[r.id] |= set(range(r.s, r.e))
            spans[r.id].append((r.s, r.e))
        assert all(masked[i] == slow_dust(s, window, threshold) for i, s in enumerate(seqs)) and any(masked.values())
        assert all(a[1] < b[0] for x in spans.values() for a, b in zip(sorted(x), sorted(x)[1:]))
    cut = homology.STRETCH
    try:
        homology.STRETCH = 7
        own = np.array([rng.choice([0, 0, 1, 5]) for _ in range(300)], dtype=np.int8)
        short = homology.perfect_intervals(own, 18, 12.0)
    finally:
        homology.STRETCH = cut
    assert short == homology.perfect_intervals(own, 18, 12.0) and short
    dimers = {r.id: r.dimer for r in homology.self_dimers(df, 9, 8).collect()}
    for i, s in enumerate(seqs):
        flipped = s.translate(FLIP)[::-1]
        assert dimers[i] == any(sum(a == b for a, b in zip(s[p : p + 9], flipped[q : q + 9])) >= 8 for p in range(len(s) - 8) for q in range(len(s) - 8))


def test_dust_and_hairpins(spark):
    rng = random.Random(1)
    mixed = "".join(rng.choice("ACGT") for _ in range(150))
    df = spark.createDataFrame([(1, mixed + "A" * 80 + mixed), (2, mixed), (3, "AC"), (4, None)], "id int, seq string")
    masked = homology.dust_intervals(df).collect()
    assert {r.id for r in masked} == {1} and masked[0].s <= 165 and masked[0].e >= 216
    stem = "ACGGTC"
    df = spark.createDataFrame([(1, "TT" + stem + "AA" + stem.translate(FLIP)[::-1] + "T"), (2, "ACGT")], "id int, seq string")
    assert [(r.id, r.pos, r.loop) for r in homology.hairpins(df).collect()] == [(1, 3, 2)]
    own = "ACGTTGCAACGTTGC"
    df = spark.createDataFrame([(1, own + own.translate(FLIP)[::-1]), (2, "A" * 40), (3, "")], "id int, seq string")
    assert {r.id: r.dimer for r in homology.self_dimers(df).collect()} == {1: True, 2: False, 3: False}


# ---------------------------------------------------------------- trees


def test_tree(spark):
    rows = [("root", None, False), ("x", "root", False), ("a", "x", True), ("b", "x", True), ("c", "root", True), ("d", "root", True)]
    nodes = spark.createDataFrame(rows, "node_id string, parent_id string, is_leaf boolean")
    up = {(r.ancestor, r.node_id): r.distance for r in tree.closure(nodes).collect()}
    assert up["root", "a"] == 2 and up["x", "b"] == 1 and up["c", "c"] == 0 and ("x", "c") not in up
    members = spark.createDataFrame([("1", "a"), ("2", "a"), ("2", "b"), ("3", "a"), ("3", "c"), ("4", "a"), ("4", "b"), ("4", "c"), ("4", "d"), ("5", "nowhere")], "cluster_id string, taxon_id string")
    got = {r.cluster_id: (r.node_id, r.penetrance) for r in tree.assign_lca(members, nodes).collect()}
    assert got == {"1": ("a", 100.0), "2": ("x", 100.0), "3": ("root", 50.0), "4": ("root", 100.0)}
    raw = spark.createDataFrame([("1", "a", "100"), ("1", "b", "100"), ("2", "a", "49.9"), ("3", "a", "x"), ("4", "a", "101"), ("2", "z", "60")], "cluster_id string, node_id string, penetrance string")
    assert {r.cluster_id: r.node_id for r in tree.relabel_low(raw).collect()} == {"1": "a", "2": "z"}
    low = raw.where("node_id = 'a'")
    assert {r.cluster_id: r.node_id for r in tree.relabel_low(low).collect()} == {"1": "a", "2": "_LOWPEN_"}
    assert tree.relabel_low(low, drop_label=True).count() == 1


def test_bipartitions(spark):
    masks = spark.createDataFrame([([m],) for m in (0b0011, 0b1100, 0b0001, 0b1111, 0b0111)], "mask array<long>")
    got = {r.mask[0]: r["count"] for r in tree.count_bipartitions(masks, 4, 2.0, spark.createDataFrame([([0b0011],), ([0b1100],)], "mask array<long>")).collect()}
    assert got == {0b0011: 5.0, 0b0001: 2.0, 0b1000: 2.0}
    splits = [(0b000011, 5.0, 2), (0b000110, 5.0, 2), (0b000111, 4.0, 3), (0b110000, 1.0, 2)]
    kept = tree.cull(splits)
    assert kept == [0b000011, 0b000111, 0b110000]
    rows = tree.build_tree(kept, list("abcdef"), ["f"])
    parent = {n: p for n, p, _ in rows}
    assert sum(leaf for _, _, leaf in rows) == 6 and parent["f"] == "IN_00000" and parent["a"] == parent["b"] != parent["c"] and parent[parent["a"]] == parent["c"]
    members = spark.createDataFrame([(c, t) for c, ts in {"1": "ab", "2": "ab", "3": "abc", "4": "d", "5": "abcd"}.items() for t in ts], "cluster_id string, taxon_id string")
    assert {r.node_id for r in tree.consensus_tree(spark, members).where("is_leaf").collect()} == set("abcd")


def test_many_taxa(spark):
    """Splits of 150 taxa in three words equal those of Python's sets; the tree holds every taxon."""
    rng = random.Random(16)
    taxa = [f"t{i:03d}" for i in range(150)]
    groups = [set(rng.sample(taxa, rng.choice([1, 2, 74, 75, 76, 149]))) for _ in range(60)] + [set(taxa[:70]), set(taxa[:70]), set(taxa[:30]), set(taxa)]
    members = spark.createDataFrame([(i, t) for i, g in enumerate(groups) for t in g] , "cluster_id int, taxon_id string")
    index = tree.taxon_index(spark.createDataFrame([(t,) for t in taxa], "taxon_id string"))
    masks = tree.cluster_masks(members, index)
    got = {tree.as_int(r.mask): (r["count"], r["size"]) for r in tree.count_bipartitions(masks, 150).collect()}
    want = Counter()
    for g in groups:
        side = set(taxa) - g if 2 * len(g) > 150 or 2 * len(g) == 150 and taxa[-1] in g else g
        want[sum(1 << taxa.index(t) for t in side)] += 1
    assert got == {m: (float(n), m.bit_count()) for m, n in want.items() if m}
    rare = {r.taxon_id for r in tree.rarest_taxa(masks, index).collect()}
    seen = {t: sum(t in g for g in groups if len(g) > 1) for t in taxa}
    assert rare == {t for t in taxa if seen[t] == min(seen.values())}
    pair = lambda a, b: spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(tree.compatible(F.col("a"), F.col("b")).alias("c"), tree.subset(F.col("a"), F.col("b")).alias("s")).first()
    assert tuple(pair([0, 3, 0], [0, 7, 1])) == (True, True) and tuple(pair([0, 3, 1], [0, 6, 0])) == (False, False) and tuple(pair([1, 0, 0], [0, 1, 0])) == (True, False)
    rows = tree.consensus_tree(spark, members).collect()
    assert {r.node_id for r in rows if r.is_leaf} == set(taxa) and sum(r.parent_id is None for r in rows) == 1


def test_guide_tree_and_root(spark):
    rows = [("r", None, False), ("x", "r", False), ("y", "r", False), ("a", "x", True), ("b", "x", True), ("z", "y", False), ("e", "y", True), ("c", "z", True), ("unknown", "z", True), ("d", "z", True)]
    guide = spark.createDataFrame(rows, "node_id string, parent_id string, is_leaf boolean")
    index = tree.taxon_index(spark.createDataFrame([(t,) for t in "abcde"], "taxon_id string"))
    masks = tree.guide_masks(guide, index)
    assert {tree.as_int(r.mask) for r in masks.collect()} == {0b00011, 0b11100, 0b01100}
    own = spark.createDataFrame([([0b00011],)], "mask array<long>")
    got = {tree.as_int(r.mask): r["count"] for r in tree.count_bipartitions(own, 5, 0.5, masks).collect()}
    assert got == {0b00011: 1.5, 0b01100: 1.0}, "the two sides of the guide's root are one split"
    rows = tree.build_tree([0b00011, 0b01100], list("abcde"), ["c", "d"])
    parent = {n: p for n, p, _ in rows}
    assert parent["c"] == parent["d"] and parent[parent["c"]] == "IN_00000", "the root lies above the outgroup's common ancestor"
    assert parent["a"] == parent["b"] and parent[parent["a"]] == parent["e"] and parent[parent["e"]] == "IN_00000"
    members = spark.createDataFrame([("1", t) for t in "abcde"], "cluster_id string, taxon_id string")
    nodes = {r.node_id: r.parent_id for r in tree.consensus_tree(spark, members, guide=guide, root=False).collect()}
    assert nodes["c"] == nodes["d"] and nodes[nodes["c"]] == nodes["e"], "rooted beside the first taxon"


def test_genetic_codes():
    assert S.genetic_code(1) == S.STANDARD_CODE == S.genetic_code(11)
    of = lambda n, codon: cluster.translate(codon, S.genetic_code(n))
    assert (of(2, "AGA"), of(2, "TGA"), of(3, "CTG"), of(6, "TAA"), of(12, "CTG"), of(25, "TGA"), of(33, "AGG")) == ("*", "W", "T", "Q", "S", "G", "K")
    with pytest.raises(ValueError):
        S.genetic_code(7)
    with pytest.raises(ValueError):
        Params(translation_table=20)


# ---------------------------------------------------------------- clusters


def test_alignment():
    a, b = cluster.global_alignment("ACGTACGT", "ACGACGT")
    assert len(a) == len(b) and a.replace("-", "") == "ACGTACGT" and b.replace("-", "") == "ACGACGT" and sum(x == y for x, y in zip(a, b)) == 7
    rng = random.Random(5)
    base = "".join(rng.choice("ACGT") for _ in range(60))
    seqs = [base, base[:20] + base[23:], base[:40] + "TTT" + base[40:], "ACG" + base]
    for rows, plain in ((cluster.star_alignment(seqs), seqs), (cluster.align_by_protein([s[: len(s) // 3 * 3] + "A" for s in seqs]), [s[: len(s) // 3 * 3] + "A" for s in seqs])):
        assert len({len(r) for r in rows}) == 1 and [r.replace("-", "") for r in rows] == plain
    assert cluster.translate("ATGGCCTAAN") == "MA*"


def test_distance_and_upgma(spark):
    rows = [("f", "1", "ACGT-A"), ("f", "2", "ACGA-A"), ("f", "3", "A--TCA"), ("g", "4", "--"), ("g", "5", "AC")]
    df = spark.createDataFrame(rows, "family string, uid string, aligned string")
    d = {(r.a, r.b): r.d for r in cluster.pairwise_distance(df).collect()}
    assert d["1", "2"] == pytest.approx(1 - 4 / 5) and d["1", "3"] == pytest.approx(0) and d["4", "5"] == -1
    assert {(r.a, r.b): r.d for r in cluster.pairwise_distance(df, 1.0).collect()}["1", "3"] == pytest.approx(1 - 3 / 6)
    n_runs = spark.createDataFrame([("f", "1", "ACGTNNNN"), ("f", "2", "ACGTACGT")], "family string, uid string, aligned string")
    assert cluster.pairwise_distance(n_runs).first().d == 0.0, "N is a gap"
    m = np.array([[0, 0.1, 0.5, 0.6], [0.1, 0, 0.5, 0.6], [0.5, 0.5, 0, 0.2], [0.6, 0.6, 0.2, 0]])
    assert cluster.upgma_labels(4, m, 0.05) == [0, 0, 1, 2] and cluster.upgma_labels(4, m, 0.1) == [0, 0, 1, 1] and cluster.upgma_labels(4, m, 1) == [0] * 4
    assert cluster.upgma_labels(1, np.zeros((1, 1)), 0) == [0]


def test_consensus(spark):
    df = spark.createDataFrame([("k", "AC-GT"), ("k", "AG-CT"), ("k", "AG--A")], "k string, aligned string")
    assert cluster.consensus(df, ["k"]).first().seq == "AGCT" and cluster.aligned_consensus(df, ["k"]).first().reference == "AG-CT"


def test_cluster_genes(spark):
    rng = random.Random(8)
    base = "ATG" + "".join(rng.choice("ACGT") for _ in range(87))
    far = "ATG" + "".join(rng.choice("ACGT") for _ in range(87))
    rows = [("g", "u1", base), ("g", "u2", base[:30] + base[33:]), ("g", "u3", far), ("h", "u4", "ATGAAA")]
    clusters, members = cluster.cluster_genes(spark.createDataFrame(rows, "family string, uid string, seq string"))
    seqs, of = {r.cluster_id: r.seq for r in clusters.collect()}, {r.uid: r for r in members.collect()}
    assert of["u4"].cluster_id == "h_00000" and of["u4"].cigar == "6=" and seqs["h_00000"] == "ATGAAA"
    assert of["u1"].cluster_id == of["u2"].cluster_id != of["u3"].cluster_id and seqs[of["u1"].cluster_id] == base
    assert of["u1"].cigar == "90=" and sum(int(x) for x in __import__("re").findall(r"(\d+)[=X]", of["u2"].cigar)) == 87


# ---------------------------------------------------------------- selection


def slow_spacing(n, d, probe):
    return probe if d == 1 else max(1, (n - probe) // (d - 1) if n < 2 * probe else (probe - 1) // (d - 1))


def test_tiling_arithmetic(spark):
    probe = 10
    df = spark.createDataFrame([(n, d) for n in (10, 18, 19, 20, 57) for d in (1, 2, 5, 10)], "len int, d int")
    for r in df.select("len", "d", select.spacing(F.col("len"), F.col("d"), probe).alias("s"), select.bait_count(F.col("len"), F.col("d"), probe).alias("n"), select.max_density(F.col("len"), probe).alias("m")).collect():
        assert r.s == slow_spacing(r.len, r.d, probe) and r.n == -(-(r.len - probe + 1) // r.s) and r.m == (probe if r.len >= 19 else r.len - 9)


def test_probes_are_centred(spark):
    text = "ACGTTGCA" * 5
    rows = [("r1", "n", "c", 5, len(text), 2, text), ("r2", "n", "c", 90, 10, 1, text[:10])]
    probes = select.emit_probes(spark.createDataFrame(rows, "region_id string, node_id string, cluster_id string, pos int, len int, density int, seq string"), 10).collect()
    starts = sorted(r.clust_pos - 5 for r in probes if r.region_id == "r1")
    assert all(text[s : s + 10] == r.seq for s, r in zip(starts, sorted((r for r in probes if r.region_id == "r1"), key=lambda r: r.clust_pos)))
    assert abs(starts[0] - (len(text) - 10 - starts[-1])) <= 1 and [r.clust_pos for r in probes if r.region_id == "r2"] == [90]


def test_spread_and_constant_density(spark):
    assert select.max_spread([0, 1, 5, 9, 10]) == [0, 10, 5, 1, 9] and select.max_spread([3]) == [3]
    rng = random.Random(17)
    for _ in range(40):
        at = sorted(rng.sample(range(200), rng.randrange(3, 30)))
        want, pairs = [at[0], at[-1]], [(0, len(at) - 1)]
        for a, b in pairs:
            inner = list(range(a + 1, b))
            if inner:
                k = next((i for i in inner if at[i] - at[a] >= (at[b] - at[a]) / 2), inner[-1])
                want.append(at[k])
                pairs += [(a, k), (k, b)]
        assert select.max_spread(at) == want and sorted(want) == at
    regions = spark.createDataFrame([("r", 75), ("q", 300)], "region_id string, len int")
    best = select.constant_density(regions, 75, 10).first()
    assert best.probes <= 10 and select.constant_density(regions, 75, 1).count() == 0


def test_priorities_and_caps(spark):
    org = spark.createDataFrame([("r1", "a"), ("r2", "a"), ("r2", "b"), ("r3", "b")], "region_id string, org string")
    regions = spark.createDataFrame([("r1", 90, 1), ("r2", 80, 0), ("r3", 100, 0)], "region_id string, len int, spread int")
    ordered = select.priority_order(org, regions)
    assert {(r.org, r.region_id): r.priority for r in ordered.collect()} == {("a", "r1"): 1, ("a", "r2"): 2, ("b", "r3"): 1, ("b", "r2"): 2}
    assert {r.region_id for r in select.cap_regions(org, ordered, 1).collect()} == {"r1", "r3"}


# ---------------------------------------------------------------- targets


def test_target_regions(spark):
    contig = "".join(random.Random(2).choice("ACGT") for _ in range(200))
    notes = spark.createDataFrame([("g+", "p", "1", 51, 110, "+"), ("g-", "p", "1", 11, 70, "-")], "gene_id string, path string, chr string, start int, end int, strand string")
    genes = targets.genes_with_flanks(notes, spark.createDataFrame([("p", "1", contig)], "path string, chr string, seq string"), 20)
    got = {r.gene_id: (r.up, r.down, r.seq) for r in genes.collect()}
    assert got["g+"] == (20, 20, contig[30:130]) and got["g-"] == (20, 10, contig[0:90].translate(FLIP)[::-1])
    members = spark.createDataFrame([("c", "g+", "t1", None), ("c", "g-", "t2", "10=5D50=")], "cluster_id string, gene_id string, taxon_id string, cigar string")
    regions = spark.createDataFrame([("c", 21, 41), ("c", 1, 4)], "cluster_id string, s int, e int")
    found = {r.gene_id: r for r in targets.target_regions(regions, members, genes, 20, 5).collect()}
    plus, minus = found["g+"], found["g-"]
    assert (plus.start, plus.end) == (66, 95) and plus.seq == contig[65:95]
    assert (minus.start, minus.end) == (31, 60) and minus.seq == contig[30:60].translate(FLIP)[::-1]
    probes = spark.createDataFrame([("t", "c", 1), ("t", "c", 5), ("t", "c", 40)], "taxon_id string, cluster_id string, clust_pos int")
    assert sorted((r.s, r.e) for r in targets.collapse_probes(probes, 10).collect()) == [(1, 15), (40, 50)]
    several = probes.withColumn("cluster_id", F.lit("c")).withColumn("clust_pos", F.col("clust_pos") + 9)
    sizes = {mode: targets.plan_targets(several, members, genes, 10, 5, mode).count() for mode in ("none", "probe", "context")}
    assert sizes["none"] > sizes["probe"] >= sizes["context"] > 0
    with pytest.raises(ValueError):
        targets.plan_targets(probes, members, genes, 10, 5, "other")
    df = spark.createDataFrame([("t", "1", 5, 9), ("t", "1", 10, 12), ("t", "1", 20, 22)], "taxon_id string, chr string, start int, end int")
    assert sorted((r.s, r.e) for r in targets.merge_targets(df).collect()) == [(5, 13), (20, 23)]


def test_params():
    p = Params(gc_min=70, gc_max=30)
    assert (p.gc_min, p.gc_max) == (30, 70) and Params().with_genomes(4).probes == 400
    with pytest.raises(ValueError):
        Params(penetrance=101)
    assert Params.from_pairs({"length": "80", "gc-min": "20.5", "nonsense": "1"}) == Params(length=80, gc_min=20.5)
    assert Counter([Params().length])[75] == 1


def test_packed_kmers_and_gc_runs(spark):
    from tilewright.operators import kmers

    rng = random.Random(4)
    seqs = ["", "ACG", "ACGTNACGTTACG", "".join(rng.choice("ACGT") for _ in range(200))]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)] + [(9, None)], "id int, seq string")
    value = lambda w: int("".join(str("ACGT".index(c)) for c in w), 4)
    for canonical in (True, False):
        want = {(i, p + 1, value(min(w, w.translate(FLIP)[::-1]) if canonical else w)) for i, s in enumerate(seqs) for p in range(len(s) - 3) if "N" not in (w := s[p : p + 4])}
        assert {tuple(r) for r in kmers.packed_kmers(df, 4, canonical).collect()} == want
    plain = df.where("id <> 2")
    slow = intervals.collapse_runs(identify.gc_windows(plain, 20, 8, 12, 3), ["id"], length=20)
    assert Counter((r.id, r.pos, r.len, r.n) for r in kmers.gc_runs(plain, 20, 8, 12, 3).collect()) == Counter((r.id, r.pos, r.len, r.n) for r in slow.collect())
