"""Source divergence audit: how far each source's use of terms is from every other source of its language, and by which terms.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z lower-cased. Tasks count a piece of the documents each: occurrences and
documents of every (lang, source, term). These counts are dealt to shards by the hash of lang and term, so all that is known of a term meets in one
shard, where DuckDB runs vectorised SQL: it adds the counts up, drops the terms that too few documents of the language hold and packs each kept term with its
sources into a row. A second pass over such rows gives each shard's part of the sums over pairs of sources and its best terms of each
source; Spark adds the parts up and ranks them.

p = 1 + floor(unit * (count + prior) / (N + prior * V)) of all kept terms, so a term that a source doesn't have has the source's constant z. With a's and b's terms
A and B, the sum of abs(p_a - p_b) over all V terms is

    sum over A of abs(p_a - z_b) + sum over B of abs(z_a - p_b) + (V - |A| - |B|) * abs(z_a - z_b)
    + sum over A and B of (abs(p_a - p_b) - abs(p_a - z_b) - abs(z_a - p_b) + abs(z_a - z_b))

The first two need only how many terms a source has of each count; the last is the shards' part, whose work is the pairs of
sources that share a term. Nothing is made for terms that neither has.

All arithmetic is in whole numbers. DuckDB has one thread and a bound of memory per task and spills beyond it.

Defined results: null text, lang and source are ''; a group counts if it has a row, with or without terms, and a language without kept terms has pairs of
value 0; repeated rows and ids count each; texts of any length are cut at white space into pieces of a few MB; ties of value go by
the item's UTF-8 bytes; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.common import as_bytes, groups, ship
from tilewright.session import discard, materialize

#: What separates terms becomes a blank, A-Z becomes a-z.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
PIECE = 4 << 20
#: Entries that a counting task holds before it passes them on.
HELD = 1 << 19
#: Rows of counts per shard, about: 20 MB or so.
SHARD = 1 << 20
#: Groups up to which their constants are broadcast; more are joined.
FEW_GROUPS = 50_000

COUNTED = "lang string, source string, term string, n long, docs long"
KEPT = "lang string, term string, total long, sources array<string>, counts array<long>"
PARTS = "part string, lang string, source string, item string, value decimal(38,0)"


@dataclass(frozen=True)
class Audit:
    """min_documents: of its language that hold a term; prior: added to each count; unit: what shares are parts of; top: terms listed per source; memory: of DuckDB in a task."""

    min_documents: int = 30
    prior: int = 5
    unit: int = 1_000_000_000
    top: int = 50
    memory: str = "300MB"


def term_counts(text: bytes) -> Counter[bytes]:
    """Occurrences of each term of a text."""
    if len(text) <= PIECE:
        return Counter(text.translate(LETTERS).split())
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(LETTERS)
        if at + PIECE < len(text):  # a term may go on beyond the piece
            end = piece.rfind(b" ") + 1
            while not end:  # a term longer than the piece
                more = text[at + len(piece) : at + 2 * len(piece)].translate(LETTERS)
                piece += more
                end = piece.find(b" ", len(piece) - len(more)) + 1 if more else len(piece)
            piece = piece[:end]
        out.update(piece.split())
        at += len(piece)
    return out


def count_terms(docs: DataFrame) -> DataFrame:
    """documents(text, lang, source) -> COUNTED, several rows for a key."""
    ship(docs.sparkSession)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], tuple[dict, dict]] = {}
        entries = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                terms = list(n)
                for i in range(0, len(terms), 1 << 16):
                    some = terms[i : i + (1 << 16)]
                    own = [pa.array([x] * len(some), pa.binary()).cast(pa.string()) for x in (lang, source)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())], schema=schema)
            held.clear()

        for batch in batches:
            for piece in groups([batch], "text"):
                for text, lang, source in zip(*(as_bytes(piece.column(c)) for c in range(3))):
                    n, docs = held.setdefault((lang, source), ({}, {}))
                    before = len(n)
                    for term, k in term_counts(text).items():
                        n[term] = n.get(term, 0) + k
                        docs[term] = docs.get(term, 0) + 1
                    entries += len(n) - before
                if entries >= HELD:
                    yield from emit()
                    entries = 0
        yield from emit()

    return docs.select(F.col("text").cast("string").alias("text"), *named).mapInArrow(run, COUNTED)


def _in_duckdb(rows: DataFrame, setup: list[str], results: list[str], schema: str, memory: str) -> DataFrame:
    """Each partition by itself is the view ``shard``: ``setup`` statements, then the rows of each of ``results``."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        first = next(batches, None)
        if first is None:
            return
        folder = tempfile.mkdtemp(prefix="shard-")
        con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": os.path.join(folder, "spill"), "preserve_insertion_order": False})
        try:

            def all_batches() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            reader = pa.RecordBatchReader.from_batches(first.schema, all_batches())
            con.register("arriving", reader)
            con.execute(f"create table shard as select {', '.join(names)} from arriving")
            for statement in setup:
                con.execute(statement)
            for query in results:
                yield from con.sql(query).fetch_record_batch(1 << 14)
        finally:
            con.close()
            shutil.rmtree(folder, ignore_errors=True)

    return rows.mapInArrow(run, schema)


def kept_terms(counted: DataFrame, shards: int, a: Audit = Audit()) -> DataFrame:
    """COUNTED -> KEPT: a row per term that enough documents of its language hold, with its sources and their counts."""
    dealt = counted.repartition(shards, "lang", "term")
    query = f"""select lang, term, sum(n)::bigint as total, list(source) as sources, list(n::bigint) as counts
        from (select lang, term, source, sum(n) as n, sum(docs) as docs from shard group by all) group by lang, term having sum(docs) >= {a.min_documents}"""
    return _in_duckdb(dealt, [], [query], KEPT, a.memory)


def _share(n: str, total: str, v: str, a: Audit) -> str:
    return f"(1 + ({a.unit}::hugeint * ({n} + {a.prior})) // ({total} + {a.prior} * {v}))"


def shard_parts(met: DataFrame, a: Audit = Audit()) -> DataFrame:
    """Rows (lang, term, in_lang, source, n, total, v, lang_total), all of a term in one partition -> PARTS: the pairs' sums over shared terms, and each source's best terms of the shard."""
    setup = [
        f"""create table own as select lang, dense_rank() over (order by lang, term) as t, source, term, n, {_share("n", "total", "v", a)}::bigint as p, {_share("0", "total", "v", a)}::bigint as z,
            {_share("in_lang", "lang_total", "v", a)}::bigint as q from shard""",
        "drop table shard",
    ]
    pairs = """select 'pair' as part, lang, source, item, sum(abs(p - p2) - abs(p - z2) - abs(z - p2) + abs(z - z2))::decimal(38,0) as value
        from (select x.lang, x.source, y.source as item, x.p, x.z, y.p as p2, y.z as z2 from own x join own y on x.t = y.t and x.source < y.source) group by all"""
    terms = f"""select 'term' as part, lang, source, term as item, (p - q)::decimal(38,0) as value from own where n > 0 and p > q
        qualify row_number() over (partition by lang, source order by p - q desc, term) <= {a.top}"""
    return _in_duckdb(met, setup, [pairs, terms], PARTS, a.memory)


def _long(column: Column) -> Column:
    return column.cast("long")


def audit(docs: DataFrame, a: Audit = Audit(), few: int = FEW_GROUPS, shards: int | None = None) -> DataFrame:
    """documents(text, lang, source) -> lang, source, part, item, value, rank."""
    present = materialize(docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct(), "groups")
    counted = materialize(count_terms(docs), "counted")
    shards = shards or max(docs.sparkSession.sparkContext.defaultParallelism, -(-counted.count() // SHARD))
    kept = materialize(kept_terms(counted, shards, a), "kept")
    discard(counted)

    shares = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    steps = materialize(shares.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")), "steps")
    of_group = steps.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("terms")).alias("total"), F.sum("terms").alias("held"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
    every = present.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "held", "v", "lang_total"])
    unit, prior = F.lit(a.unit).cast("decimal(20,0)"), a.prior

    def share(n: Column) -> Column:
        over = (F.col("total") + prior * F.col("v")).cast("decimal(20,0)")
        return F.when(over > 0, 1 + _long(F.call_function("div", unit * (n + prior).cast("decimal(18,0)"), over))).otherwise(0)

    constants = materialize(every.withColumn("z", share(F.lit(0))), "constants")
    n_groups = constants.count()

    rows = kept.select("lang", "term", F.col("total").alias("in_lang"), F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", "term", "in_lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    known = constants.select("lang", "source", "total", "v", "lang_total")
    if n_groups <= few:
        met = rows.join(F.broadcast(known), ["lang", "source"])  # leaves each term's rows together
    else:
        met = rows.join(known, ["lang", "source"]).repartition(shards, "lang", "term")
    parts = materialize(shard_parts(met.select("lang", "term", "in_lang", "source", "n", "total", "v", "lang_total"), a), "parts")

    met_at = parts.where("part = 'pair'").groupBy("lang", "source", F.col("item").alias("other")).agg(_long(F.sum("value")).alias("shared"))
    # what a source's own counts are from the other's constant: by steps, not by terms
    mine = steps.join(constants.select("lang", "source", "total", "v"), ["lang", "source"]).select("lang", "source", share(F.col("n")).alias("p"), "terms")
    levels = constants.select("lang", F.col("source").alias("other"), F.col("z").alias("z_other"))
    apart = mine.join(levels, "lang").where("source <> other").groupBy("lang", "source", "other").agg(F.sum(F.abs(F.col("p") - F.col("z_other")) * F.col("terms")).alias("apart"))
    apart = materialize(apart, "apart")
    left = constants.select("lang", "source", "held", "v", "z")
    right = constants.select("lang", F.col("source").alias("other"), F.col("held").alias("held_other"), F.col("z").alias("z_other"))
    both = left.join(right, "lang").where("source < other")
    both = both.join(apart, ["lang", "source", "other"], "left").join(apart.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("apart").alias("apart_other")), ["lang", "source", "other"], "left").join(met_at, ["lang", "source", "other"], "left")
    rest = (F.col("v") - F.col("held") - F.col("held_other")) * F.abs(F.col("z") - F.col("z_other"))
    summed = both.select("lang", "source", "other", (rest + sum(F.coalesce(F.col(c), F.lit(0)) for c in ("apart", "apart_other", "shared"))).alias("value"))
    mirrored = F.explode(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item")))).alias("x")
    pairs = summed.select("lang", mirrored, "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", _long(F.col("value")).alias("value")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= a.top)
    return ranked.unionByName(terms)
