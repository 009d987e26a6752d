"""The toxicity model: features by hand, and accuracy on held-out rows of planted texts."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tilewright.llm import toxicity
from tilewright.llm.toxicity import FEATURES, Fit, Lexicon
from tilewright.session import table

FAST = Fit(trees=6)


def measured(text, odds=None):
    return dict(zip(FEATURES, toxicity.features(text.encode(), Lexicon(odds or {}), frozenset(toxicity.INSULTS), frozenset(toxicity.SECOND), 5)))


def test_features():
    x = measured("You are an IDIOT!! a b c d e f g", {"idi": 4.0, "are ": 1.5, "an ": 0.2})
    assert x["insults"] == pytest.approx(1000 / 11) and x["strong"] == pytest.approx(1000 / 11) and x["weak"] == pytest.approx(1000 / 11)
    assert x["weight"] == pytest.approx(5500 / 11) and x["near_second"] == x["second"] == pytest.approx(1000 / 11)
    assert x["capitals"] == pytest.approx(6 / 20) and x["calls"] == pytest.approx(2000 / 32)
    assert measured("idiot word word word word word you")["near_second"] == 0 < measured("idiot word word word word you")["near_second"]
    assert set(measured("").values()) == set(measured(" 12 --").values()) == {0.0}
    for text in ("what an 1d10t idi0t", "m0r0n here", "such $cum scu@m lo$er"):
        assert measured(text)["disguised"] > 0, text
    assert measured("i d i o t")["disguised"] > 0 and measured("version 2.0 of 3x4 a1 b2 abc1def")["disguised"] == 0
    assert measured("x " * 20_000 + "A1" * 50_000)["words"] > 0  # one word of many signs takes linear time


def test_terms_and_lexicon():
    assert list(toxicity.terms_of("abcdefgh")) == ["abcdefgh ", "abc", "abcd", "abcde", "abcdef"] and list(toxicity.terms_of("ab")) == ["ab "]
    words = Lexicon({"abc": 2.0, "abcd ": 3.0, "low": 0.5})
    assert [words.of(w) for w in ("abcd", "abcde", "lower", "ab")] == [3.0, 2.0, 0.0, 0.0]


def planted(n=900, seed=5):
    """(doc_id, text, toxic): one text in five holds words of insulting stems with endings of their own, or listed insults."""
    rng = random.Random(seed)
    syllables = "ka lo mi ter ans ung que ar sol dre vin pol".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum"]) if i % 10 else rng.choice(["zugrax", "frobble"]) + rng.choice(syllables)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows, labels=None):
    docs = spark.createDataFrame([(i, text, "x", 7, 0.5, 0) for i, text, _ in rows], "doc_id long, text string, features string, fold int, score double, toxic int")
    return docs, spark.createDataFrame(labels if labels is not None else [(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")


def test_held_out_accuracy_and_no_leak(spark):
    rows = planted()
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in toxicity.toxicity(docs.repartition(3), labels, FAST).collect()}
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {i for i, r in got.items() if r.held_out} == held and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    wrong = [i for i, _, y in rows if i in held and got[i].predicted != y]
    assert len(wrong) <= 0.03 * len(held)
    docs, flipped = frames(spark, rows, [(i, 1 - y if i in held else y, 0) for i, _, y in rows])
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(3), flipped, FAST).collect()}
    assert again == {i: r.score for i, r in got.items()}, "labels of held-out rows were seen"


def test_many_copies_teach_one_text(spark):
    """A third of the labelled rows are one harmless text that is marked toxic: its words don't become insults."""
    rows = planted(600)
    copies = [(10_000 + i, "perfectly harmless sentence about gardening", 1) for i in range(300)]
    docs, labels = frames(spark, rows + copies)
    model = toxicity.fit(docs, labels, FAST)
    assert "gardening " not in model.lexicons[0] and "frobbl" in model.lexicons[0]


def test_odd_tables(spark):
    rows = planted(300)
    odd = [(None, "idiot scum idiot", 0), (10**12, None, 0), (10**12 + 1, "", 0), (3, "another text of a known id", 0), (3, "another text of a known id", 0), (-5, "日本 idiot", 0), (-6, "word " * 100_000 + "idiot", 0)]
    labels = [(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (5, None, 1), (5, 1, 0), (10**12, None, None)]
    docs, labels = frames(spark, rows + odd, labels)
    got = toxicity.toxicity(docs, labels, FAST).collect()
    assert len(got) == len(rows) + len(odd) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert len({r.score for r in got if r.doc_id in (10**12, 10**12 + 1)}) == 1
    assert toxicity.toxicity(docs.where("false"), labels, FAST).count() == 0


def test_too_few_labels(spark):
    docs, labels = frames(spark, planted(50))
    assert {r.score for r in toxicity.toxicity(docs, labels.where("false"), FAST).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.withColumn("toxic", F.lit(1)), FAST).collect()} == {1.0}
    for kept in (labels.where("doc_id < 7"), labels.where(toxicity.fold(F.col("doc_id")) < 3)):
        assert toxicity.toxicity(docs, kept, FAST).where("score between 0 and 1").count() == 50


def test_sample_bounds_what_is_learned_from(spark):
    docs, labels = frames(spark, planted(600))
    assert 60 < toxicity.known_rows(docs, labels, Fit(sample=100)).count() < 140
    assert toxicity.known_rows(docs, labels, Fit(sample=10_000)).count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(600))


def test_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] >= 0.88 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) <= 0.03 * n[0, 0]
