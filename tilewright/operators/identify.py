"""Windows that tell nodes apart: pseudo-genomes, k-mer uniqueness, composition, melting temperature."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.functions import seq as S
from tilewright.operators.intervals import merge_intervals, segment_offsets, subtract_intervals
from tilewright.operators.kmers import gc_windows, kmer_summary, spans_of, unshared_runs  # noqa: F401
from tilewright.session import materialize

#: Unified nearest-neighbour enthalpies (kcal/mol) and entropies (cal/mol/K) of DNA duplexes, SantaLucia 1998.
NEIGHBOURS = {
    "AA": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}
#: Fixed values of the same source: corrections for each end of the duplex.
END_AT, END_GC = (2.3, 4.1), (0.1, -2.8)
GAS, CONCENTRATION, SALT = 1.987, 1e-6, 0.075


def neighbour_table() -> dict[str, tuple[float, float]]:
    """All 16 pairs: a pair and its reverse complement are the same duplex."""
    flip = str.maketrans(S.BASES, S.COMPLEMENT)
    return NEIGHBOURS | {k.translate(flip)[::-1]: v for k, v in NEIGHBOURS.items()}


def pseudo_genomes(clusters: DataFrame, least: int) -> DataFrame:
    """clusters(cluster_id, node_id, seq) -> + ord, start in the node's string of clusters; nodes shorter than ``least`` go. Nothing is concatenated."""
    placed = segment_offsets(clusters, ["node_id"], ["cluster_id"], F.length("seq"))
    long_ = clusters.groupBy("node_id").agg(F.sum(F.length("seq") + 1).alias("t")).where(F.col("t") >= least)
    return placed.join(long_, placed["node_id"].eqNullSafe(long_["node_id"]), "left_semi")


#: Bases of sequences whose shared k-mers (8 bytes each) may be broadcast; beyond, they are marked in pieces.
BROADCAST = 1 << 21


def _labelled(seqs: DataFrame) -> DataFrame:
    """seqs(node_id, seq, ...) -> the same with label, a number per node, for node_id."""
    nodes = seqs.select("node_id").distinct().withColumn("label", F.row_number().over(W.orderBy("node_id")).cast("long"))  # a row per node
    nodes = materialize(nodes, "node-numbers")
    return seqs.join(nodes, seqs["node_id"].eqNullSafe(nodes["node_id"])).select(*(seqs[c] for c in seqs.columns if c != "node_id"), "label")


def shared_kmers(seqs: DataFrame, k: int) -> DataFrame:
    """seqs(node_id, seq) -> kmer: every k-mer that, on either strand, occurs in two nodes or more."""
    return kmer_summary(_labelled(seqs.select("node_id", "seq")), k, "labels").select("kmer")


def unique_starts(seqs: DataFrame, length: int, k: int, first: int = 1, broadcast_kmers: int = BROADCAST) -> DataFrame:
    """seqs(id, node_id, seq) -> id, s, e: half-open runs of window starts (1-based) that hold no k-mer of another node.

    A shared k-mer at p rules out the starts from p - (length - k) to p: never a row per window. Of few bases the shared k-mers go to the sequences; of more than
    ``broadcast_kmers`` they are marked piece by piece (``kmers.unshared_runs``).
    """
    bases = seqs.agg(F.sum(F.length("seq")).alias("n")).first().n or 0
    if bases > broadcast_kmers:
        return unshared_runs(_labelled(seqs.select("id", "node_id", "seq")), k, length, first, bases)
    starts = seqs.where(F.length("seq") >= length + first - 1).select("id", F.lit(first).alias("s"), (F.length("seq") - length + 2).alias("e"))
    shared = shared_kmers(seqs, k).collect()  # fewer than broadcast_kmers
    bad = spans_of(seqs, np.sort(np.array([r.kmer for r in shared], dtype=np.int64)), k, length)
    return subtract_intervals(starts, bad, ["id"]).drop("piece")


def window_tm(seqs: DataFrame, length: int, first: int = 1) -> DataFrame:
    """seqs(id, seq of ACGT) -> id, pos, tm of every window.

    Sums over a window are differences of running sums along the sequence, one NumPy pass for each; Spark's own windows would
    need a row and a shuffle per base.
    """
    table = neighbour_table()
    dh, ds = np.zeros(25), np.zeros(25)
    for pair, (h, s) in table.items():
        at = S.BASES.index(pair[0]) * 5 + S.BASES.index(pair[1])
        dh[at], ds[at] = h, s
    code = np.full(256, 4, dtype=np.int64)
    code[[ord(b) for b in S.BASES]] = range(4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch.column(0), batch.column(1).to_pylist()):
                n = len(text or "") - length + 1
                if n < first:
                    continue
                base = code[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
                pairs = base[:-1] * 5 + base[1:]
                h, s = (np.concatenate(([0.0], np.cumsum(x[pairs]))) for x in (dh, ds))
                h, s = h[length - 1 :] - h[: -length + 1], s[length - 1 :] - s[: -length + 1]
                ends = [(base == 0) | (base == 3)]
                for at in (slice(0, n), slice(length - 1, length - 1 + n)):
                    weak = ends[0][at]
                    h = h + np.where(weak, END_AT[0], END_GC[0])
                    s = s + np.where(weak, END_AT[1], END_GC[1])
                tm = 1000 * h / (s + GAS * np.log(CONCENTRATION / 4)) + 12 * np.log10(SALT) - 273.15
                pos = np.arange(first, n + 1)
                yield pa.RecordBatch.from_arrays([pa.array([own.as_py()] * len(pos), batch.schema.field(0).type), pa.array(pos, pa.int32()), pa.array(tm[first - 1 :])], ["id", "pos", "tm"])

    kind = seqs.schema["id"].dataType.simpleString()
    return seqs.select("id", "seq").mapInArrow(run, f"id {kind}, pos int, tm double")


def best_tm_interval(tms: DataFrame, width: float) -> DataFrame:
    """tms(node_id, tm) -> low, high, nodes: the half-open interval of ``width`` degrees, in steps of 0.01, in which most nodes have a window; of equals the highest.

    Each node rules a union of interval starts in; adding up where these begin and end gives the count at every start.
    """
    steps = round(width * 100)
    bins = tms.select("node_id", F.floor(F.col("tm") * 100).alias("bin")).distinct()
    reach = merge_intervals(bins.select("node_id", (F.col("bin") - steps + 1).alias("s"), (F.col("bin") + 1).alias("e")), ["node_id"])
    events = reach.select(F.col("s").alias("at"), F.lit(1).alias("d")).unionAll(reach.select("e", F.lit(-1))).groupBy("at").agg(F.sum("d").alias("d"))
    order = W.orderBy("at")  # at most one row for each hundredth of a degree
    counted = events.select("at", F.sum("d").over(order).alias("nodes"), F.lead("at").over(order).alias("next"))
    best = counted.where("next is not null").select(F.max(F.struct("nodes", (F.col("next") - 1).alias("low"))).alias("b"))
    return best.select((F.col("b.low") / 100).alias("low"), ((F.col("b.low") + steps) / 100).alias("high"), F.col("b.nodes").alias("nodes"))


def middle_of_runs(runs: DataFrame, n: int) -> DataFrame:
    """runs(node_id, id, s, e) -> node_id, id, pos: the middle start of each node's n longest runs."""
    order = W.partitionBy("node_id").orderBy(F.desc(F.col("e") - F.col("s")), "id", "s")
    return runs.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).select("node_id", "id", F.floor((F.col("s") + F.col("e") - 1) / 2).cast("int").alias("pos"))
