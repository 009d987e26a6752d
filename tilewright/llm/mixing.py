"""Mixing sources to target weights by Pareto order sampling.

Targets: each source gets its weight's share of ``budget`` words, at most ``cap`` times its size; what is over is
reshared by weight until none is above its limit (solved at once: sources run into their limits in the order of
limit / weight).

Within a source documents are wanted unequally: a document's expected copies are proportional to its measure (by default
the bits of its size, so that a text of 10,000 words is wanted nearly twice as often as one of 100), at most ``cap``, and scaled so that the
expected words add up to the target. The whole part of the expected copies is certain. The fractional part is its inclusion
probability ``p`` in a sample of fixed size: with a uniform number ``u`` hashed from (doc_id, size, number among equal rows), documents are ranked by
``(u / (1 - u)) / (p / (1 - p))`` and taken in that order until the sample's words come as near to the rest as whole documents allow.

No source is ever gathered in one task: the order's cut is found by two rounds of 256-bin histograms per source,
and only the rows of one bin of the second round are ranked. Equal rows are numbered within the tasks that hold them, and the counts
of tasks are added up. The tables of sources and of their measures (some 20 each) are written to
the shared folder and broadcast by Spark only below its threshold.

Defined results: null texts have size 0; the null source is a source, last in order; a source without words has target
0; documents without words are not taken; rows equal in (source, doc_id, size), also null ids, are numbered and drawn for each, so reruns agree in what is taken of them
(where the rows themselves are returned, they are numbered in the order of a hash of their contents, so reruns agree on which of several texts under one id and size, too); an empty table gives
an empty result; extra columns pass by, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.session import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
BINS = 256
BITS = 52


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """Strictly between 0 and 1, from 52 bits of an MD5; the same on every run and engine."""
    digest = F.md5(F.concat(F.lit(seed + "|"), key))
    return (F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").cast("double") + 0.5) / float(1 << BITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, budget: float = 1.0) -> DataFrame:
    """sizes(source, source_size), a row per source -> + target.

    Sources in order of code points, nulls last, get the weights in turn. One row per source: a window over these rows is small.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(order) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")).cast("long")
    rows = sizes.select("source", "source_size", w.alias("weight"), (F.col("source_size") * cap).alias("limit"))
    run = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    first = run.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    total = F.floor(F.sum("source_size").over(whole) * F.lit(budget)).cast("long")
    left = total - F.coalesce(F.sum("limit").over(first), F.lit(0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(first), F.lit(0))
    rows = rows.select("*", left.alias("left"), heavy.alias("heavy"))
    fits = F.col("limit") * F.col("heavy") <= F.col("left") * F.col("weight")  # those up to here stop at their limits
    rows = rows.withColumn("stops", fits)
    open_at = F.min(F.when(~F.col("stops"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull().cast("int"), F.coalesce("source", F.lit("")), F.col("left").alias("left"), F.col("heavy").alias("heavy")))).over(whole)
    rows = rows.withColumn("level", open_at)
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise((F.col("level.left") * F.col("weight")).cast("double") / F.col("level.heavy"))
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


KEYS = ("source", "doc_id", "size")


def _same(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def repeated_keys(sized: DataFrame) -> DataFrame | None:
    """The keys of several rows of sized, or None."""
    peers = materialize(sized.groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1").select(*KEYS), "repeated")
    return None if peers.isEmpty() else peers


def numbered(rows: DataFrame, peers: DataFrame | None) -> DataFrame:
    """Adds nth: 0, 1, ... among rows with equal KEYS. No task gathers a key: each numbers its own rows, and the counts of the tasks are added up.

    With a column ``print``, a hash of the row's contents, rows are numbered in its order, so the layout decides between rows of equal contents only.
    """
    zero = F.lit(0).cast("long")
    if peers is None:
        return rows.withColumn("nth", zero)
    keys = (*KEYS, "print") if "print" in rows.columns else KEYS
    single = rows.join(peers, _same(rows, peers), "left_anti").withColumn("nth", zero)
    held = materialize(rows.join(peers, _same(rows, peers), "left_semi").withColumn("_task", F.spark_partition_id()), "repeated-rows")
    of_task = materialize(held.groupBy(*keys, "_task").agg(F.count("*").alias("n")), "repeated-counts")
    before = of_task.select(*keys, "_task", (F.sum("n").over(W.partitionBy(*keys).orderBy("_task")) - F.col("n")).alias("_before"))
    if "print" in keys:  # contents are counted in 256 lots of a key, then within each lot
        lot = F.shiftright("print", 56).alias("_lot")
        of_print = of_task.groupBy(*KEYS, lot, "print").agg(F.sum("n").alias("n"))
        of_lot = of_print.groupBy(*KEYS, "_lot").agg(F.sum("n").alias("n"))
        lots = of_lot.select(*KEYS, "_lot", (F.sum("n").over(W.partitionBy(*KEYS).orderBy("_lot")) - F.col("n")).alias("_lots"))
        inside = of_print.select(*keys, "_lot", (F.sum("n").over(W.partitionBy(*KEYS, "_lot").orderBy("print")) - F.col("n")).alias("_prints"))
        placed = inside.join(lots, _same(inside, lots, (*KEYS, "_lot"))).select(*(inside[c] for c in keys), (F.col("_lots") + F.col("_prints")).alias("_ahead"))
        before = before.join(placed, _same(before, placed, keys)).select(*(before[c] for c in keys), "_task", (F.col("_before") + F.col("_ahead")).alias("_before"))
    own = held.withColumn("_own", F.row_number().over(W.partitionBy(*keys, "_task").orderBy(zero)) - 1)
    joined = own.join(before, _same(own, before, (*keys, "_task")))
    return single.unionByName(joined.select(*(own[c] for c in rows.columns), (F.col("_own") + F.col("_before")).cast("long").alias("nth")))


def measure_of(size: Column) -> Column:
    """Bits of the size; 0 for texts without words. Few values: a row for each of a source's is kept."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("long")


def expected_copies(classes: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """classes(source, measure, words), targets(source, target) -> source, measure, whole, rate, rest (of the source).

    The expected copies are min(cap, c * measure) with c such that they come to the target: measures run into the cap from the largest down.
    """
    t = targets.select(F.col("source").alias("t_source"), "target")
    rows = classes.where("words > 0").join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    down = W.partitionBy("source").orderBy(F.desc("measure"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weighted = F.sum(F.col("measure") * F.col("words")).over(W.partitionBy("source").orderBy("measure").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("c", (F.col("target") - (above * cap).cast("double")) / weighted)
    fits = F.when(F.col("c") * F.col("measure") <= cap, F.struct(F.col("measure").alias("m"), F.col("c").alias("c")))
    rows = rows.withColumn("c", F.max(fits).over(W.partitionBy("source"))["c"])  # of the largest measure below the cap
    rows = rows.withColumn("copies", F.coalesce(F.greatest(F.least(F.col("c") * F.col("measure"), F.lit(float(cap))), F.lit(0.0)), F.lit(float(cap))))
    rows = rows.withColumn("whole", F.floor("copies").cast("long"))
    rest = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(W.partitionBy("source")).cast("double")
    return rows.select("source", "measure", "whole", (F.col("copies") - F.col("whole")).alias("rate"), rest.alias("rest"))


def _rank(u: Column, rate: Column) -> Column:
    return (u / (1 - u)) / (rate / (1 - rate))


def _draw(seed: str) -> Column:
    key = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("doc_id", "size", "nth")))
    return uniform(key, seed)


def _bin(rank: Column) -> Column:
    """The rank squeezed into BINS * BINS equal steps of rank / (1 + rank)."""
    return F.least(F.lit(BINS * BINS - 1), F.floor(rank / (1 + rank) * (BINS * BINS))).cast("int")


def _cut(rows: DataFrame, step: Column) -> DataFrame:
    """rows(source, rest, before, size) -> source, cut (the bin in which the words reach the rest, else the last), before (words of lower bins)."""
    sums = rows.groupBy("source", step.alias("cut")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("base"))
    until = F.col("base") + F.sum("words").over(W.partitionBy("source").orderBy("cut"))
    every = F.col("base") + F.sum("words").over(W.partitionBy("source"))
    crossing = sums.select("*", until.alias("until"), every.alias("every")).where(F.col("until") >= F.least("rest", F.col("every")))
    return crossing.groupBy("source").agg(F.min(F.struct("cut", (F.col("until") - F.col("words")).alias("before"))).alias("c")).select("source", "c.cut", "c.before")


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, budget: float = 1.0, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """sized(doc_id, source, size, measure, nth) -> two small tables: source, source_size, target, cut_bin, edge; and source, measure, whole, rate.

    A document is in the sample where its bin is below cut_bin, or equal to it and (rank, doc_id, size, nth) at most the edge.
    """
    classes = materialize(sized.groupBy("source", "measure").agg(F.sum("size").alias("words")), "measures")
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, cap, budget).select("source", "source_size", "target"), "targets")
    wanted = materialize(expected_copies(classes, targets, cap), "wanted")
    open_ = wanted.where("rate > 0").select(F.col("source").alias("t_source"), F.col("measure").alias("t_measure"), "rate", "rest")
    ranked = sized.where("size > 0").join(open_, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("measure") == F.col("t_measure"))).drop("t_source", "t_measure")
    ranked = ranked.withColumn("rank", _rank(_draw(seed), F.col("rate"))).withColumn("bin", _bin(F.col("rank")))
    zero = F.lit(0).cast("long")
    first = materialize(_cut(ranked.withColumn("before", zero), F.floor(F.col("bin") / BINS).cast("int")), "cut")
    coarse = first.withColumnsRenamed({"source": "c_source", "cut": "coarse"})
    inside = ranked.join(coarse, F.col("source").eqNullSafe(F.col("c_source")) & (F.floor(F.col("bin") / BINS) == F.col("coarse"))).drop("c_source")
    second = materialize(_cut(inside, F.col("bin")), "cut")
    fine = second.withColumnsRenamed({"source": "f_source", "cut": "cut_bin"})
    last = ranked.join(fine, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("bin") == F.col("cut_bin"))).drop("f_source")
    until = F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("rank", F.col("doc_id").isNull(), "doc_id", "size", "nth").rowsBetween(W.unboundedPreceding, 0))
    near = last.withColumn("until", until).where(2 * F.col("until") - F.col("size") <= 2 * F.col("rest"))
    edge = near.groupBy("source").agg(F.max(_place()).alias("edge"))
    bins = fine.select(F.col("f_source").alias("source"), "cut_bin")
    out = targets.join(bins, _same(targets, bins, ("source",)), "left").drop(bins["source"])
    out = out.join(edge, _same(targets, edge, ("source",)), "left").drop(edge["source"])
    plan = materialize(out, "mix-plan")
    discard(classes, targets, first, second)
    return plan, wanted


def _place() -> Column:
    return F.struct("rank", F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "size", "nth")


def apply_mix(sized: DataFrame, plan: tuple[DataFrame, DataFrame], seed: str = "mix") -> DataFrame:
    """Adds source_size, target and copies (how often the mix takes the document whole) to rows with doc_id, source, size, measure and nth."""
    p = plan[0].select(F.col("source").alias("p_source"), "source_size", "target", "cut_bin", "edge")
    w = plan[1].select(F.col("source").alias("w_source"), F.col("measure").alias("w_measure"), "whole", "rate")
    joined = sized.join(p, F.col("source").eqNullSafe(F.col("p_source")), "left").join(w, F.col("source").eqNullSafe(F.col("w_source")) & (F.col("measure") == F.col("w_measure")), "left")
    joined = joined.withColumn("rank", F.when(F.col("rate") > 0, _rank(_draw(seed), F.col("rate")))).withColumn("bin", _bin(F.col("rank")))
    extra = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (_place() <= F.col("edge")))
    copies = F.when(F.col("size") > 0, F.coalesce("whole", F.lit(0)) + F.coalesce(extra, F.lit(False)).cast("long")).otherwise(0)
    return joined.withColumn("copies", copies).drop("p_source", "w_source", "w_measure", "whole", "rate", "cut_bin", "edge", "rank", "bin")


def _sized(docs: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    size = n_words(F.col("text"))
    return docs.select(*(x.alias(c) for c, x in (more or {}).items()), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), measure_of(size).alias("measure"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, budget: float = 1.0, seed: str = "mix") -> DataFrame:
    """documents(doc_id, text, source) -> doc_id, size, source_size, target, taken."""
    sized = materialize(_sized(docs), "sizes")
    sized = numbered(sized, repeated_keys(sized))
    mixed = apply_mix(sized, plan_mix(sized, weights, cap, budget, seed), seed)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeat_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, budget: float = 1.0, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of documents as often as the mix takes it, with its columns as they were."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    prints = {"print": F.xxhash64(*hashed)}
    sized = materialize(_sized(docs, prints), "sizes")
    peers = repeated_keys(sized)
    plan = plan_mix(numbered(sized, peers), weights, cap, budget, seed)
    discard(sized)
    own = _sized(docs, {"row": F.struct(*(F.col(f"`{c}`") for c in docs.columns)), **prints})
    many = apply_mix(numbered(own, peers), plan, seed).where("copies > 0")
    return many.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")
