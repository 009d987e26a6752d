"""The divergence audit against sums over all terms and pairs in plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from tilewright.llm import divergence
from tilewright.llm.divergence import Audit
from tilewright.session import table

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_audit(rows, a):
    """rows (text, lang, source) -> Counter of result rows."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= a.min_documents)
        mates = sorted(s for g, s in groups if g == lang)

        def shares(n, kept=kept):
            total = sum(n[t] for t in kept)
            return {t: 1 + a.unit * (n[t] + a.prior) // (total + a.prior * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in mates}
        q = shares(sum((counts[lang, s] for s in mates), Counter()))
        own = p[source]
        pairs = sorted((-sum(abs(own[t] - p[s][t]) for t in kept), s.encode()) for s in mates if s != source)
        terms = sorted((q[t] - own[t], t.encode()) for t in kept if counts[lang, source][t] and own[t] > q[t])[: a.top]
        for part, ranked in (("pair", pairs), ("term", terms)):
            out += [(lang, source, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return Counter(out)


def result(docs, *more, **named):
    return Counter(tuple(r) for r in divergence.audit(docs, *more, **named).select("lang", "source", "part", "item", "value", "rank").collect())


def odd_rows():
    long_text = " ".join(f"w{chr(97 + i % 23)}x Tail" for i in range(40_000))
    rows = [("The cat sat. THE cat!", "en", "a"), ("the dog_sat the\x00cat", "en", "b"), ("the the zebra", "en", "b"), (None, "en", "c"), ("", None, None), ("été ÉTÉ the", None, "a"), ("日本 cat x1y", "", "a"), ("12 34 --", "de", "only"), (long_text, "en", "a"), ("cat", "fr", "a"), ("dog", "fr", "a"), ("z" * 70_000 + " the", "en", "é"), ("the cat sat", "en", "d")]
    return rows + rows[:3] * 3 + [(f"word{chr(97 + i % 26)} common {'rare' * (i % 3)}", "en", f"s{i % 4}") for i in range(80)]


@pytest.mark.parametrize("few, shards", [(divergence.FEW_GROUPS, None), (0, 3), (0, 1)])
@pytest.mark.parametrize("a", [Audit(min_documents=2), Audit(min_documents=1, prior=1, unit=997, top=3), Audit()])
def test_equals_plain_sums(spark, a, few, shards):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "x", 3, 0.5) for r in rows], "text string, lang string, source string, term string, n int, value double").repartition(4)
    want = slow_audit(rows, a)
    assert result(docs, a, few=few, shards=shards) == want and want


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    want = slow_audit(rows, Audit(min_documents=10))
    assert result(docs, Audit(min_documents=10)) == want and sum(r[2] == "term" for r in want) > 100


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert result(docs) == Counter()


def test_small_pieces_and_few_entries_change_nothing(spark, monkeypatch):
    rows = odd_rows()
    whole = [divergence.term_counts((t or "").encode()) for t, *_ in rows]
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(divergence, "PIECE", size)
        if size > 2:
            assert [divergence.term_counts((t or "").encode()) for t, *_ in rows] == whole
        else:  # slow for long texts
            assert [divergence.term_counts((t or "").encode()) for t, *_ in rows if len(t or "") < 100] == [w for w, (t, *_) in zip(whole, rows) if len(t or "") < 100]


def test_memory_is_bounded_by_spilling(spark):
    """More counts than the shard's memory holds: the result is the same."""
    rows = [(" ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[j % 10]}{'uvwxyz'[j // 10 % 6]}{chr(97 + j // 60)}" for j in range(900)), "en", f"s{i % 12}") for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    a = Audit(min_documents=2, memory="40MB")
    assert result(docs, a, shards=1) == slow_audit(rows, a)
