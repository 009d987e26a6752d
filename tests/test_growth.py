"""Operators whose work grew faster than their input, or that made a row per base or place."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from tilewright import session
from tilewright.functions import cigar, seq as S
from tilewright.operators import cluster, homology, identify, intervals, kmers, tree
from tilewright.plans import queries
from tilewright.sources import gff


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_are_drawn_together_before_they_are_dealt_out(spark):
    rng = random.Random(1)
    rows = [(k, p) for k in (None, "a", "b") for p in range(1, 400) if rng.random() < 0.8]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, pos int").repartition(3)
    want = set()
    for k in (None, "a", "b"):
        own = sorted(p for q, p in rows if q == k)
        starts = [p for p in own if p - 1 not in own]
        want |= {(k, p, next(e for e in range(p, 500) if e not in own) - p) for p in starts}
    found = intervals.collapse_runs(df, ["k"], length=5)
    assert {(r.k, r.pos, r.n) for r in found.collect()} == want and all(r.len == r.n + 4 for r in found.collect())
    assert dict(found.dtypes) == {"k": "string", "pos": "int", "len": "int", "n": "bigint"}
    text = plan(found)
    assert text.index("hashpartitioning(k") < text.index("MapInArrow")  # the plan is printed from the top: rows are drawn together below the exchange


def test_window_summary_equals_window_rows(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ACGT", weights=(4, 1, 1, 4), k=rng.choice((0, 9, 10, 300))))) for i in range(40)] + [(50, None)]
    df = spark.createDataFrame(rows, "id int, seq string")
    slow = identify.gc_windows(df, 10, 2, 5, 3).groupBy("id").agg(F.count("*"), F.min("gc"), F.max("gc"))
    assert sorted(map(tuple, kmers.gc_summary(df, 10, 2, 5, 3).collect())) == sorted(map(tuple, slow.collect()))


def test_segments_take_one_pass(spark):
    df = spark.createDataFrame([(1, "AN" * 30_000), (2, None), (3, "nnNN"), (4, "acgt")], "id int, seq string")
    start = time.time()
    rows = S.segments_of_acgt(df).collect()
    assert time.time() - start < 30
    assert [(r.seq, r.offset) for r in rows if r.id == 1] == [("A", 2 * i) for i in range(30_000)]
    assert [(r.id, r.seq, r.offset) for r in rows if r.id > 1] == [(4, "ACGT", 0)]


def test_gaps_to_a_letter(spark):
    rng = random.Random(3)
    texts = {i: "".join(rng.choices("NX", weights=(1, 6), k=rng.choice((0, 1, 40)))) for i in range(30)}
    found = kmers.letter_gaps(spark.createDataFrame([*texts.items(), (99, None)], "id int, seq string"), "N")
    want = set()
    for i, t in texts.items():
        on = [p for p, c in enumerate(t) if c == "N"]
        want |= {(i, p, min((p - q for q in on if q <= p), default=-1), min((q - p for q in on if q >= p), default=-1)) for p in range(len(t))}
    assert set(map(tuple, found.collect())) == want
    assert "hashpartitioning" not in plan(found) and "rangepartitioning" not in plan(found)


def test_ranges_of_places_equal_single_ones(spark, monkeypatch):
    monkeypatch.setattr(intervals, "TILE", 4)
    segs = spark.createDataFrame([("x", 1, 3, 5), ("x", 2, 9, 20), ("y", 3, 0, 2), (None, 4, 2, 3)], "k string, segment long, start long, len int")
    ranges = spark.createDataFrame([("x", 0, 40), ("y", 0, 3), ("y", 5, 7), ("z", 0, 2), (None, 0, 6)], "k string, lo long, hi long")
    points = ranges.select("k", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("pos"))
    found = intervals.locate_ranges(ranges, segs, ["k"])
    assert sorted(map(str, found.collect())) == sorted(map(str, intervals.locate(points, segs, ["k"]).collect()))


def test_positions_of_a_long_cigar_take_one_pass(spark):
    text = "".join(f"1M{n % 2}D1I" for n in range(40_000))
    df = spark.createDataFrame([(text,)], "c string")
    start = time.time()
    found = df.select(cigar.adjust_all(F.sequence(F.lit(1), F.lit(60_001)), F.col("c")).alias("x"), cigar.simplify(F.col("c")).alias("s")).first()
    assert time.time() - start < 30
    assert found.s == text
    # two pairs of operations take three places and make four bases: the second place of three is a base two on, the deletion is at that base
    assert found.x[:6] == [1, 3, 3, 5, 7, 7] and found.x[-2:] == [79_999, None]


def test_adjust_all_equals_single_positions(spark):
    df = spark.createDataFrame([("2=3X1N2D4S1I5H6P2M", [0, 1, 5, 6, 8, 9, 10, 11, None]), ("", [1]), (None, [1]), ("3M", None)], "c string, p array<int>")
    for greedy in (False, True):
        found = [r.x for r in df.select(cigar.adjust_all(F.col("p"), F.col("c"), greedy).alias("x")).collect()]
        assert found == [[0, 1, 5, *([6] * 2 if greedy else [5] * 2), 11, 12, None, None], [None], None, None]


def test_votes_are_counted_as_a_stream(spark):
    rng = random.Random(4)
    rows = [(rng.choice(("a", "b", None, "c")), "".join(rng.choices("ACGT-N", k=rng.choice((5, 12))))) for _ in range(60)] + [("gaps", "---"), ("none", None), ("void", "")]
    df = spark.createDataFrame(rows, "k string, aligned string").repartition(5)

    def slow(key, gap):
        own = [x for k, x in rows if k == key and x is not None]
        columns = [[x[i] for x in own if i < len(x) and x[i] in "ACGT"] for i in range(max(map(len, own), default=0))]
        return "".join(min(set(c), key=lambda b: (-c.count(b), b)) if c else gap for c in columns)

    found = cluster.consensus(df, ["k"])
    assert {r.k: r.seq for r in found.collect()} == {k: slow(k, "") for k in ("a", "b", "c", None)}
    assert {r.k: r.reference for r in cluster.aligned_consensus(df, ["k"]).collect()} == {k: slow(k, "-") for k in ("a", "b", "c", None, "gaps", "void")}
    assert "Generate" not in plan(found)  # no row per base


def test_dimers_and_hairpins_equal_brute_force(spark):
    rng = random.Random(5)
    flip = str.maketrans("ACGT", "TGCA")
    texts = {i: "".join(rng.choices("ACGT", k=rng.choice((0, 8, 14, 20, 31)))) for i in range(60)}
    df = spark.createDataFrame([*texts.items(), (99, None)], "id int, seq string")

    def dimer(t, window, least):
        back, n = t.translate(flip)[::-1], len(t)
        return any(sum(t[i + k] == back[j + k] for k in range(window)) >= least for i in range(n - window + 1) for j in range(n - window + 1))

    found = {r.id: r.dimer for r in homology.self_dimers(df, 9, 7).collect()}
    assert found == {i: dimer(t, 9, 7) for i, t in texts.items()} | {99: False} and len(set(found.values())) == 2
    want = {(i, p + 1, loop) for i, t in texts.items() for loop in (1, 2, 3) for p in range(len(t) - 6 - loop + 1) if t[p : p + 3].translate(flip)[::-1] == t[p + 3 + loop : p + 6 + loop]}
    assert want and set(map(tuple, homology.hairpins(df, stem=3).collect())) == want


def test_taxa_meet_once_in_tasks_that_rows_need(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_OF_TASK", 10)
    df = spark.createDataFrame([(i % 50, i % 3) for i in range(300)], "k int, v int")
    assert session.dealt_by_size(df, 300, "k").rdd.getNumPartitions() == 30
    nodes = spark.createDataFrame([("a", "x", True), ("b", "x", True), ("c", "r", True), ("x", "r", False), ("r", None, False)], "node_id string, parent_id string, is_leaf boolean")
    members = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "a"), (3, "c")], "cluster_id int, taxon_id string")
    found = {tuple(r) for r in tree.assign_lca(members, nodes).collect()}
    assert found == {(1, "x", 100.0), (2, "c", 100.0), (3, "r", 200 / 3)}


def test_members_are_dealt_out_once(spark, sf):
    found = queries._taxa_members(spark, sf).groupBy("cluster_id").agg(F.collect_set("taxon_id").alias("taxa"))
    assert plan(found).count("Exchange hashpartitioning") == 1


def test_runs_carry_columns_and_regions_leave_bases_behind(spark, sf):
    df = spark.createDataFrame([(1, "x", "ACGT" * 5), (2, None, "AAAA" * 5)], "id int, org string, seq string")
    assert {tuple(r) for r in kmers.gc_runs(df, 8, 3, 6, with_seq=True, keep=["org"]).collect()} == {(1, 1, 20, 13, "ACGT" * 5, "x")}
    assert queries._regions(spark, sf).columns == ["id", "node_id", "org", "pos", "len", "region_id"]


def test_features_keep_their_taxon(spark):
    df = spark.createDataFrame([("p", "t", 0, "c1\tx\tCDS\t1\t6\t.\t+\t0\tID=g")], "path string, taxon_id string, part int, text string")
    assert gff.features(df).first().taxon_id == "t" and "taxon_id" not in gff.features(df.drop("taxon_id")).columns


def test_kmers_travel_in_few_bytes():
    rng = random.Random(6)
    for k in (4, 15, 31):
        raw = np.unique(np.array([rng.randrange(1 << 2 * k) for _ in range(5000)], dtype=np.int64))
        values = np.sort(kmers.mixed(raw, k))
        assert len(np.unique(values)) == len(raw) and sorted(kmers.unmixed(values, k).tolist()) == raw.tolist()
        cuts = kmers.bucket_cuts(values, k, 7)
        assert cuts[0] == 0 and cuts[-1] == len(values) and (np.concatenate([kmers.unsqueeze(kmers.squeeze(values[a:b])) for a, b in zip(cuts, cuts[1:]) if b > a]) == values).all()
    assert len(kmers.squeeze(np.arange(0, 1 << 20, 200, dtype=np.uint64))) < 2 * (1 << 20) // 200
    assert kmers._of_labels(kmers._labels(np.array([-5, 300, -5]))).tolist() == [-5, 300, -5]


def test_marked_pieces_equal_broadcast_kmers(spark, monkeypatch):
    monkeypatch.setattr(kmers, "PIECE", 150)
    monkeypatch.setattr(kmers, "BUCKET", 100)
    rng = random.Random(7)
    rows = [(i, rng.choice(("a", "b", None)), "".join(rng.choices("ACGTN", weights=(9, 9, 9, 9, 1), k=rng.choice((0, 5, 12, 90))))) for i in range(60)] + [(99, "a", None)]
    df = spark.createDataFrame(rows, "id int, node_id string, seq string")
    for length, k, first in ((12, 5, 1), (8, 8, 3)):
        a, b = (identify.unique_starts(df, length, k, first, most) for most in (1 << 20, 0))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0
        assert a.dtypes == b.dtypes


def slow_distance(x, y, penalty):
    base = [(p in "ACGT", q in "ACGT", p == q) for p, q in zip(x, y)]
    over = sum(p and q for p, q, _ in base) + penalty * sum(p != q for p, q, _ in base)
    return 1 - sum(p and q and e for p, q, e in base) / over if over else -1.0


def test_pairs_meet_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_ROWS", 5)
    monkeypatch.setattr(cluster, "BLOCK_BASES", 700)
    rng = random.Random(12)
    rows = []
    for family, n, length, letters in (("one", 1, 5, "ACGT"), ("two", 2, 64, "ACGT"), ("many", 31, 200, "ACGT"), ("gaps", 23, 130, "AACCGT-Nn"), ("void", 3, 4, "-"), ("none", 2, 0, "A")):
        rows += [(family, f"{family[0]}{i}", "".join(rng.choices(letters, k=length))) for i in range(n)]
    rows += [("many", "m0", rows[5][2]), ("many", None, "A" * 200), (None, "x", "A"), (None, "y", "A")]  # an id twice, and none
    df = spark.createDataFrame(rows, "family string, uid string, aligned string").repartition(3)
    for penalty in (0.0, 0.5):
        want = sorted((f, a, b, slow_distance(x, y, penalty)) for f, a, x in rows for g, b, y in rows if f and f == g and a and b and a < b)
        found = cluster.pairwise_distance(df, penalty)
        assert sorted(map(tuple, found.collect())) == want
    assert found.dtypes == [("family", "string"), ("a", "string"), ("b", "string"), ("d", "double")]


def test_dna_of_any_text(spark):
    texts = ["Hello, World", "", None, "ÄßKK\x00aé1z", "123"]
    got = [r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.dna_of_text(F.col("t")).alias("s")).collect()]
    slow = lambda t: "".join("ACGT"[(ord(c.lower()) - 97) % 4] for c in t if c.isascii() and c.isalpha())
    assert got == [None if t is None else slow(t) for t in texts]


def related(rng, n, length, letters="ACGT", copies=0.4):
    """Texts of one length that come from few: copies, near copies and others."""
    texts = ["".join(rng.choices(letters, k=length))]
    while len(texts) < n:
        old = rng.choice(texts)
        rate = 0 if rng.random() < copies else rng.choice([0.02, 0.05, 0.08, 0.8])
        texts.append("".join(rng.choice(letters) if rng.random() < rate else c for c in old))
    return texts


def test_clusters_without_pair_rows_equal_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_ROWS", 7)
    rng = random.Random(13)
    rows = [(f"f{k}", f"{rng.random():.6f}", t) for k in range(6) for t in related(rng, rng.choice((2, 9, 60)), rng.choice((20, 100, 150)))]
    rows += [("void", "v1", "--"), ("void", "v2", "--"), ("one", "o", "ACGT"), ("gaps", "g1", "AC-TNN"), ("gaps", "g2", "ACGT--"), ("gaps", "g3", "ACGTAA"), (None, "x", "A"), (None, "y", "A")]
    df = spark.createDataFrame(rows, "family string, uid string, aligned string").repartition(3)
    distances = cluster.pairwise_distance(df)
    for cut in (0.02, 0.075, 0.25):
        found = cluster.family_clusters(df, cut)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, cluster.upgma_clusters(distances, cut).collect()))
    assert dict(found.dtypes) == {"family": "string", "uid": "string", "part": "int"}


def test_average_linkage_equals_the_least_of_the_matrix():
    rng = np.random.default_rng(14)
    for n in (1, 2, 3, 12, 40):
        for kinds in (2, 4, 1000):
            d = rng.integers(0, kinds, (n, n)) / 7
            d = np.triu(d, 1) + np.triu(d, 1).T
            want, left, size, node = [], np.where(np.eye(n, dtype=bool), np.inf, d), [1] * n, list(range(n))
            for k in range(n - 1):
                i, j = divmod(int(left.argmin()), n)
                want.append((node[i], node[j], float(left[i, j]) / 2))
                left[i] = left[:, i] = (size[i] * left[i] + size[j] * left[j]) / (size[i] + size[j])
                left[j] = left[:, j] = np.inf
                left[i, i] = np.inf
                size[i], node[i] = size[i] + size[j], n + k
            assert cluster.upgma_tree(n, d) == want


def test_copies_take_no_room_in_a_cluster(spark):
    """20,000 copies of two texts: their pairs alone would be 2 * 10 ** 8."""
    df = spark.range(20_000).selectExpr("'f' as family", "cast(id as string) as uid", "if(id % 3 = 0, repeat('ACGT', 25), repeat('AAGG', 25)) as aligned")
    start = time.time()
    assert {tuple(r) for r in cluster.family_clusters(df, 0.05).select("part", (F.col("uid") % 3 == 0).alias("x")).distinct().collect()} == {(0, True), (1, False)}
    assert time.time() - start < 60


def test_places_without_a_wanted_key_are_no_rows(spark, monkeypatch):
    rng = random.Random(29)
    texts = lambda name, n, length: spark.createDataFrame([(f"{name}{i}", "".join(rng.choices("ACGTN", (9, 9, 9, 9, 1), k=length))) for i in range(n)], "id string, seq string")
    a, b = texts("a", 30, 400), texts("b", 3, 60)
    for seeds in (["1" * 5], ["1101011", "11100011", "1111"]):
        few = sorted(map(tuple, homology.spaced_hits(a, b, seeds).collect()))
        wanted = np.unique([r.key for r in homology.spaced_runs(homology.both_strands(b), seeds).collect()])
        rows = sorted(map(tuple, homology.spaced_runs(a, seeds, wanted=wanted).collect()))
        assert rows == sorted(tuple(r) for r in homology.spaced_runs(a, seeds).collect() if r.key in set(wanted.tolist())) and rows
        with monkeypatch.context() as m:
            m.setattr(homology, "SENT", 0)
            assert few and few == sorted(map(tuple, homology.spaced_hits(a, b, seeds).collect()))
    assert homology.spaced_hits(a, b.where("false")).count() == 0
