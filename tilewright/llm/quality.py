"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Fixed base rules reject texts that are short or repeat themselves. The others are judged against their own language
and source: for each such group and feature a sketch counts values in buckets of 6 significant bits (relative error
below 1/32). Sketches are integer counts, so they merge by addition in any order to the same result; here they are partial
aggregates that Spark merges. A group's fence is its quartiles widened by ``reach`` times their distance, though, so that a source of
which over a quarter is junk doesn't set its own rule, no further than what 95% of the language's texts stay within (all its sources' sketches
merged). Most texts have none of some features, and both quartiles are 0; what is usual beyond the fence then tells sources apart: a limit is the
fence plus half of ``slack`` plus twice the group's mean excess over the fence, a text's excess counting up to the
slack and the language's mean as that of ``prior`` more texts. So where a trait is common more of it passes, and a third of
junk adds less than its own distance. Thresholds, a row per group, are written out and joined back.

Defined results: null text is empty; null language or source is a group of its own; texts of fewer than 10 words fail; a
group whose texts all failed has no thresholds and needs none; repeated rows count and are judged each; an
empty table gives an empty result; extra columns pass by, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.common import groups, ship
from tilewright.session import discard, materialize

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Words from which a text's windows are counted as integers.
LONG = 2000


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat (percent of words) are the base rules; slack: of each feature, in its unit; tail: percent of a language beyond which no fence goes; prior: texts' worth of the language in a group's mean excess."""

    min_words: int = 10
    max_repeat: int = 20
    window: int = 5
    reach: int = 4
    tail: int = 5
    prior: int = 20
    slack: dict[str, int] = field(default_factory=lambda: {"symbols": 200, "dup_lines": 100, "repeats": 300, "word_size": 300})


#: Feature -> numerator and scale over n_words; word_size is limited on both sides, the others above.
FEATURES = {"symbols": ("n_symbols", 1000), "dup_lines": ("n_dup_lines", 1000), "repeats": ("n_repeat_words", 1000), "word_size": ("word_chars", 100)}


def repeated_words(words: list[bytes], window: int) -> int:
    """Words in windows that occur twice or more."""
    if len(words) <= window:
        return 0
    runs = list(zip(*(words[i:] for i in range(window))))
    if len(set(runs)) == len(runs):
        return 0
    often = Counter(runs)
    hit = np.fromiter((often[r] > 1 for r in runs), dtype=np.int64, count=len(runs))
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[: len(runs)] += hit
    edges[window : window + len(runs)] -= hit
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def repeated_in_windows(text: bytes, words: list[bytes], window: int) -> int:
    """repeated_words; long texts number their words first and hold integers instead of tuples."""
    if len(words) <= LONG:
        return repeated_words(words, window)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    n = len(ids) - window + 1
    runs = ids[:n]
    for i in range(1, window):  # the runs of i words are numbered, so a pair with the next word fits a long
        _, runs = np.unique(runs * len(number) + ids[i : i + n], return_inverse=True)
    hit = (np.bincount(runs) > 1)[runs].astype(np.int64)
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    edges[:n] += hit
    edges[window:] -= hit
    return int((np.cumsum(edges) > 0).sum())


def with_counts(docs: DataFrame, window: int = 5, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Adds the columns COUNTS (names after ``prefix``), computed from the whole text, to the columns ``keep`` of docs (all by default). A text goes to Python once, kept or not."""
    ship(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    if dict(docs.dtypes)["text"] != "string":
        docs = docs.withColumn("text", F.col("text").cast("string"))
    held = keep if "text" in keep else [*keep, "text"]
    at = held.index("text")
    own = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(held)))
    schema = T.StructType([*own.schema.fields[: len(keep)], *(T.StructField(f"_n{i}", T.LongType()) for i in range(len(COUNTS)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, f"_{at}"):
            texts = batch.column(at)
            points = np.asarray(pc.fill_null(pc.utf8_length(texts), 0), dtype=np.int64).tolist()
            rows = []
            for i, n in enumerate(points):
                text = (texts[i].as_py() or "").encode()
                words = text.split()
                blanks, symbols = len(text) - len(text.translate(None, SPACE)), len(text) - len(text.translate(None, SYMBOLS))
                rows.append((len(words), n - blanks, symbols, repeated_lines(text), repeated_in_windows(text, words, window)))
            counts = [pa.array(x, pa.int64()) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *counts], [f.name for f in schema.fields])

    names = {f"_{i}": c for i, c in enumerate(keep)} | {f"_n{i}": prefix + c for i, c in enumerate(COUNTS)}
    return own.mapInArrow(run, schema).withColumnsRenamed(names)


def base_failed(r: Rules, prefix: str = "") -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < r.min_words) | (100 * repeated > r.max_repeat * words)


def feature(name: str, prefix: str = "") -> Column:
    """A whole number; only texts with words have one."""
    over, scale = FEATURES[name]
    return F.expr(f"case when {prefix}n_words > 0 then ({scale} * {prefix}{over}) div {prefix}n_words end")


def bucket(value: Column) -> Column:
    """The least value with the same 6 leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(counted: DataFrame, r: Rules) -> DataFrame:
    """counted (lang, source, COUNTS) -> lang, source, feature, bucket, n: sketches that add up."""
    ok = counted.where(~base_failed(r)).select("lang", "source", F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), feature(f).alias("value")) for f in FEATURES))))
    return ok.groupBy("lang", "source", "feature", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def thresholds(sketches: DataFrame, r: Rules) -> DataFrame:
    """A row per (lang, source): least and most of each feature, within what the language allows."""

    def quantiles(rows: DataFrame, keys: list[str], parts: dict[str, int]) -> DataFrame:
        group = W.partitionBy(*keys)
        ranked = rows.select("*", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(group).alias("all"))
        at = lambda k: F.min(F.when(100 * F.col("upto") >= k * F.col("all"), F.col("bucket")))
        return ranked.groupBy(*keys).agg(*(at(k).alias(name) for name, k in parts.items()))

    slack = F.element_at(F.create_map(*(x for f, s in r.slack.items() for x in (F.lit(f), F.lit(s)))), F.col("feature"))
    own = quantiles(sketches, ["lang", "source", "feature"], {"q1": 25, "q3": 75})
    merged = sketches.groupBy("lang", "feature", "bucket").agg(F.sum("n").alias("n"))
    tails = quantiles(merged, ["lang", "feature"], {"low": r.tail, "high": 100 - r.tail}).withColumnsRenamed({"lang": "_lang", "feature": "_feature"})
    both = own.join(tails, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("feature") == F.col("_feature")))
    wide = F.lit(r.reach) * (F.col("q3") - F.col("q1"))
    fences = both.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("feature").alias("_feature"), F.greatest(F.col("q1") - wide, F.col("low")).alias("below"), F.least(F.col("q3") + wide, F.col("high")).alias("above"), slack.alias("slack"))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("feature") == F.col("_feature"))
    over = F.col("n") * F.greatest(F.lit(0), F.least(F.col("slack"), F.col("bucket") - F.col("above")))
    under = F.col("n") * F.greatest(F.lit(0), F.least(F.col("slack"), F.col("below") - F.col("bucket")))
    keys = ["lang", "source", "feature"]
    excess = sketches.join(fences, same).groupBy(*keys).agg(F.first("below").alias("below"), F.first("above").alias("above"), F.first("slack").alias("slack"), F.sum("n").alias("n"), F.sum(over).alias("over"), F.sum(under).alias("under"))
    whole = W.partitionBy("lang", "feature")  # a row per source

    def more(side: str) -> Column:
        """Half the slack and twice the mean excess, in whole numbers."""
        n, all_n, all_over = F.col("n"), F.sum("n").over(whole), F.sum(side).over(whole)
        return F.call_function("div", F.col("slack"), F.lit(2)) + F.call_function("div", 2 * (F.col(side) * all_n + r.prior * all_over), (n + r.prior) * all_n)

    limits = excess.select(*keys, (F.col("below") - more("under")).alias("least"), (F.col("above") + more("over")).alias("most"))
    pick = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"_{f}_{c}")
    return limits.groupBy("lang", "source").agg(*(pick(f, "most") for f in FEATURES), pick("word_size", "least"))


def judge(counted: DataFrame, limits: DataFrame, r: Rules, prefix: str = "") -> DataFrame:
    """Adds base_failed and kept (names after ``prefix``) to rows with lang, source and COUNTS (names after ``prefix``)."""
    own = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = counted.join(own, counted["lang"].eqNullSafe(own["_lang"]) & counted["source"].eqNullSafe(own["_source"]), "left")
    within = feature("word_size", prefix) >= F.col("_word_size_least")
    for f in FEATURES:
        within &= feature(f, prefix) <= F.col(f"_{f}_most")
    judged = joined.withColumn(f"{prefix}base_failed", base_failed(r, prefix))
    judged = judged.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & F.coalesce(within, F.lit(True)))
    return judged.drop("_lang", "_source", "_word_size_least", *(f"_{f}_most" for f in FEATURES))


def quality_report(docs: DataFrame, r: Rules = Rules()) -> DataFrame:
    """documents(doc_id, text, lang, source) -> doc_id, COUNTS, base_failed, kept."""
    counted = materialize(with_counts(docs, r.window, ["doc_id", "lang", "source"]), "counts")
    limits = materialize(thresholds(sketch(counted, r), r), "thresholds")
    return judge(counted, limits, r).select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, r: Rules = Rules()) -> DataFrame:
    """The rows of documents that are kept, with their columns. Texts are counted twice: that is cheaper than moving each to its verdict."""
    counted = materialize(with_counts(docs, r.window, ["lang", "source"]), "counts")
    limits = materialize(thresholds(sketch(counted, r), r), "thresholds")
    discard(counted)
    prefix = "_tilewright_"
    rows = with_counts(docs, r.window, prefix=prefix)
    return judge(rows, limits, r, prefix).where(F.col(f"{prefix}kept")).select(*(F.col(f"`{c}`").cast(docs.schema[c].dataType) for c in docs.columns))
