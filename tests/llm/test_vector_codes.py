"""Product codes against a plain Lloyd iteration in Python's whole numbers."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.llm import vector_codes
from tilewright.llm.vector_codes import Codes
from tilewright.session import table


def slow_codes(rows, c):
    """rows (vec_id, vector, label) -> Counter of result rows, by assigning and averaging everything anew each round."""
    usable = [(i, [(c.scale * Fraction(x)).__floor__() for x in v], raw, label) for i, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v) for raw in [v]]
    if not usable:
        return Counter()
    often = Counter(len(v) for _, v, *_ in usable)
    n = max(often, key=lambda k: (often[k], k))
    usable = [(i, v + [0] * (-n % c.parts), raw, label) for i, v, raw, label in usable if len(v) == n]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = len(usable[0][1]) // c.parts
    cut = [[v[p * d : (p + 1) * d] for p in range(c.parts)] for _, v, *_ in usable]
    books = [[list(x[p]) for x in cut[: c.entries]] for p in range(c.parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(c.rounds):
        for p in range(c.parts):
            members = defaultdict(list)
            for x in cut:
                members[nearest(x[p], books[p])[1]].append(x[p])
            for e, own in members.items():
                books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], Counter()
    for (i, _, _, label), x in zip(usable, cut):
        found = [nearest(x[p], books[p]) for p in range(c.parts)]
        error = min(sum(f[0] for f in found), 2**63 - 1)
        total[label] += error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, label))
    return Counter((i, code, error, min(total[label], 2**63 - 1), sha) for i, code, error, label in out)


def result(df, c):
    return Counter(tuple(r) for r in vector_codes.code_report(df, c).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, part int")


def odd_rows(seed, n=120, d=8):
    rng = random.Random(seed)
    centres = [[rng.uniform(-2, 2) for _ in range(d)] for _ in range(5)]
    near = lambda c: [float(np.float32(x + rng.gauss(0, 0.3))) for x in c]
    rows = [(rng.randrange(n), near(rng.choice(centres)), rng.choice([None, 0, 1, 2])) for _ in range(n)]
    rows += [(None, near(centres[0]), 1), (None, near(centres[1]), None), rows[3], rows[3]]
    return rows + [(5, None, 1), (6, [], 0), (7, [0.5] * (d - 1) + [None], 2), (8, [float("nan")] * d, 1), (9, [float("inf")] * d, 1), (10, [0.25] * 3, 1)]


@pytest.mark.parametrize("c", [Codes(entries=8), Codes(parts=3, entries=5, rounds=2, scale=64), Codes(entries=256, rounds=3), Codes(parts=1, entries=2, rounds=0)])
def test_equals_plain_lloyd(spark, c):
    rows = odd_rows(c.entries)
    assert result(frame(spark, rows).repartition(5), c) == slow_codes(rows, c)


def test_large_components_are_exact(spark):
    rows = [(i, [float(i % 7), 1.0, -2.0, 0.25 * i], i % 2) for i in range(20)]
    rows += [(30, [3e38, 0.0, 1.0, 1.0], 0), (31, [-1e300, 1.7e308, 0.5, 5e-324], 1), (32, [2.0**44, 1.0, 1.0, 2.0**31], 1), (33, [2.0**44, 3.0, 1.0, -(2.0**31)], None)]
    c = Codes(parts=2, entries=4, rounds=3)
    assert result(frame(spark, rows, "double").repartition(3), c) == slow_codes(rows, c)


def test_empty_and_unusable_tables(spark):
    rows = odd_rows(1)
    assert result(frame(spark, rows).where("false"), Codes()) == Counter()
    assert result(frame(spark, [(1, None, 1), (2, [], 1), (3, [None], 0)]), Codes()) == Counter()
    plain = frame(spark, rows).select("vec_id", "embedding")
    assert len({r.label_error for r in vector_codes.code_report(plain).collect()}) == 1  # no labels: all rows are one group


def test_layout_does_not_matter(spark, sf):
    df = table(spark, sf, "embeddings")
    assert result(df, Codes()) == result(df.repartition(7), Codes())


def test_only_changes_are_passed_on(spark):
    """Well separated groups settle at once: the first round adds every part once, later ones pass nothing on."""
    rows = [(i, [float(10 * (i % 4))] * 8, 0) for i in range(64)]
    moved, real = [], vector_codes.materialize

    def watched(df, label, *more):
        out = real(df, label, *more)
        if label.startswith("round"):
            moved.append(out.where("delta is not null").select(F.inline("delta")).where("place = -1").agg(F.sum(F.abs("value"))).first()[0] or 0)
        return out

    vector_codes.materialize = watched
    try:
        state, books = vector_codes.train(frame(spark, rows), Codes(entries=4))
    finally:
        vector_codes.materialize = real
    assert moved == [4 * 64, 0, 0, 0]
    assert state.where("now is not null").where("was = now").count() == 64
    vectors = {r.vec_id: r.vector for r in vector_codes.decode(vector_codes.encode(state, books, Codes(entries=4)), books, Codes(entries=4)).collect()}
    assert vectors == {i: v for i, v, _ in rows}


def test_limbs_add_up():
    sums = vector_codes.Sums([np.zeros((2, 2), dtype=np.int64)])
    values = [-(2**100) - 5, 2**63, -1, 0]
    for v in values:
        sums.add(0, np.array([1]), np.array([[v, 7]], dtype=object), 1)
    sums.add(0, np.array([1]), np.array([[3, 7]]), -1)
    got = Counter()
    for x in sums.limbs():
        assert -(2**32) < x["value"] < 2**32
        got[x["part"], x["entry"], x["place"]] += x["value"] << (32 * x["limb"])
    assert got == {(0, 1, 0): sum(values) - 3, (0, 1, 1): 21, (0, 1, -1): 3}
