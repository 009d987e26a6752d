"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards, and each node's weight is the sum below it. A row descends from the root;
at each level every child draws ``-ln(u) / weight`` from a hash of (seed, child, key) and the smallest draw wins. A draw
depends on nothing but the key, the child's name and its weight, so a change of weights moves rows only out of
subtrees that lost weight and into subtrees that gained some. ``HashTree.grown`` adds a shard as a region of its own: no
other subtree gains weight, so rows move only into the new shard.

The children of all nodes are arrays of constants and a level is one expression over the chosen node's, so the plan
doesn't grow with the number of shards. Draws are 52 bits of an MD5, the same on any engine.

The law is ``key``: the key and the tree decide, whatever other rows there are. A slot orders a shard by bucket (a hash of what a row shows), then by key, size
and checksum. Equal rows are one row with a count until they have their first slot, and are then dealt out in lots of ``LOT``: a
row that makes up a third of the table costs a row per task. Shards are never gathered in one task.

Defined results: null keys are one key like any other; null texts have size 1 and checksum 0; an empty table gives
an empty result; repeated rows share their shard and get a slot each; extra columns are dropped, whatever their names. A tree without weight is refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.session import materialize

#: Parts of a shard whose rows one task orders: 12 bits of a hash.
BUCKETS = 4096
#: Copies of an equal row that one task deals out.
LOT = 1 << 16


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    leaves: tuple[Leaf, ...]

    @classmethod
    def uniform(cls, shards: int, racks: int = 2, per_rack: int = 2) -> HashTree:
        """Regions of racks x per_rack shards, filled in the order of shard numbers."""
        region = racks * per_rack
        return cls(tuple(Leaf(f"r{i // region}", f"r{i // region}k{i % region // per_rack}", i) for i in range(shards)))

    def grown(self) -> HashTree:
        """One more shard, in a region of its own."""
        new = max((x.shard for x in self.leaves), default=-1) + 1
        region = f"r{len({x.region for x in self.leaves})}+{new}"
        return HashTree((*self.leaves, Leaf(region, f"{region}k0", new)))

    def levels(self) -> list[list[list[tuple[str, float, int]]]]:
        """For each level and node there its children: name, weight, and the child's number on the next level (a shard's own on the last)."""
        leaves = sorted((x for x in self.leaves if x.weight > 0), key=lambda x: (x.region, x.rack, x.shard))
        if not leaves:
            raise ValueError("no shard has weight")
        racks = [[(f"{x.rack}s{x.shard}", float(x.weight), x.shard) for x in own] for _, own in groupby(leaves, lambda x: (x.region, x.rack))]
        names = [(region, rack) for (region, rack), _ in groupby(leaves, lambda x: (x.region, x.rack))]
        weigh = lambda rows: sum(w for _, w, _ in rows)
        regions = [[(names[i][1], weigh(racks[i]), i) for i in own] for _, own in groupby(range(len(names)), lambda i: names[i][0])]
        root = [[(names[own[0][2]][0], weigh(own), i) for i, own in enumerate(regions)]]
        return [root, regions, racks]


def _draw(node: Column, weight: Column, key: Column, seed: int) -> Column:
    """Exponential with the node's weight as its rate."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), node, F.lit("|"), key))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def place(key: Column, tree: HashTree, seed: int = 0) -> Column:
    """The shard of a key."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    at = F.lit(0)
    for nodes in tree.levels():
        children = F.array(*(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(w).alias("weight"), F.lit(n).alias("next")) for name, w, n in own)) for own in nodes))
        draws = F.transform(children[at], lambda x: F.struct(_draw(x["name"], x["weight"], text, seed).alias("draw"), x["next"].alias("next")))
        at = F.array_min(draws)["next"]
    return at.cast("int")


def shard_documents(docs: DataFrame, tree: HashTree, seed: int = 0) -> DataFrame:
    """documents(doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        place(F.col("doc_id"), tree, seed).alias("shard"), place(F.col("doc_id"), tree.grown(), seed).alias("grown_shard"),
    )
    return with_slots(placed, ["doc_id", "size", "text_crc32"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def with_slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """placed(shard, order, ...) -> + slot: gapless from 0 in each shard. Rows equal in ``order`` must be equal in all columns."""
    shown = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order))
    bucket = F.conv(F.substring(F.md5(shown), 1, 3), 16, 10).cast("int")
    kinds = placed.groupBy(*placed.columns).agg(F.count("*").alias("_n")).withColumn("_bucket", bucket)
    kinds = materialize(kinds, "placed")  # read twice; a row for each different row
    counts = kinds.groupBy("shard", "_bucket").agg(F.sum("_n").alias("_rows"))
    before = counts.select("shard", "_bucket", (F.sum("_rows").over(W.partitionBy("shard").orderBy("_bucket")) - F.col("_rows")).alias("_before"))
    own = F.sum("_n").over(W.partitionBy("shard", "_bucket").orderBy(*order)) - F.col("_n")
    first = kinds.withColumn("_own", own).join(before, ["shard", "_bucket"]).select(*placed.columns, "_n", (F.col("_before") + F.col("_own")).alias("_slot"))
    lots = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(LOT).cast("long"))
    many = first.where(F.col("_n") > LOT).select("*", F.explode(lots).alias("_lot")).repartition("_slot", "_lot")
    pieces = first.where(F.col("_n") <= LOT).withColumn("_lot", F.lit(0).cast("long")).unionByName(many)
    each = F.sequence(F.col("_lot"), F.least(F.col("_n"), F.col("_lot") + LOT) - 1)
    return pieces.select(*placed.columns, "_slot", F.explode(each).alias("_copy")).select(*placed.columns, (F.col("_slot") + F.col("_copy")).cast("long").alias("slot"))
