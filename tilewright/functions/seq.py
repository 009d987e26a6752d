"""Column functions over DNA strings. All but segments_of_acgt run inside the JVM's generated code; positions are 1-based."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES, COMPLEMENT = "ACGT", "TGCA"
#: Bases in one tile. Slicing a long string costs time in proportion to the position, so strings are cut into tiles first.
TILE = 512

#: The standard genetic code, codons in the order of bases T, C, A, G.
CODON_BASES = "TCAG"
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

#: What the numbered genetic codes (NCBI) read otherwise than the standard one: amino acid and codons.
OTHER_CODES = {
    2: "*AGA *AGG MATA WTGA", 3: "MATA TCTT TCTC TCTA TCTG WTGA", 4: "WTGA", 5: "SAGA SAGG MATA WTGA", 6: "QTAA QTAG", 9: "NAAA SAGA SAGG WTGA", 10: "CTGA", 11: "", 12: "SCTG",
    13: "GAGA GAGG MATA WTGA", 14: "NAAA SAGA SAGG YTAA WTGA", 15: "QTAG", 16: "LTAG", 21: "NAAA SAGA SAGG MATA WTGA", 22: "*TCA LTAG", 23: "*TTA", 24: "SAGA KAGG WTGA", 25: "GTGA", 26: "ACTG",
    27: "QTAA QTAG WTGA", 28: "QTAA QTAG WTGA", 29: "YTAA YTAG", 30: "ETAA ETAG", 31: "ETAA ETAG WTGA", 32: "WTAG", 33: "YTAA WTGA SAGA KAGG",
}


def genetic_code(number: int = 1) -> str:
    """The 64 amino acids of a numbered genetic code, codons in the order of bases T, C, A, G."""
    if number != 1 and number not in OTHER_CODES:
        raise ValueError(f"no genetic code {number}")
    out = list(STANDARD_CODE)
    for change in OTHER_CODES.get(number, "").split():
        at = [CODON_BASES.index(b) for b in change[1:]]
        out[16 * at[0] + 4 * at[1] + at[2]] = change[0]
    return "".join(out)


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, BASES, COMPLEMENT))


def gc_count(seq: Column) -> Column:
    """Letters G and C: what is left without the other bases."""
    return F.length(F.regexp_replace(seq, "[^GC]", ""))


def gc_of_acgt(seq: Column) -> Column:
    """The same for strings of ACGT only, without a pattern."""
    return F.length(F.translate(seq, "AT", ""))


_LETTERS = bytes(range(65, 91)), bytes(range(97, 123))
_AS_BASE = bytes.maketrans(b"".join(_LETTERS), (BASES * 7)[:26].encode() * 2)
_NO_LETTER = bytes(set(range(256)) - set(b"".join(_LETTERS)))


def dna_of_text(text: Column) -> Column:
    """A DNA view of any text: its ASCII letters, a to z mapped to ACGT in turn."""

    @F.arrow_udf("string")
    def dna(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else t.translate(_AS_BASE, _NO_LETTER) for t in texts.cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())

    return dna(text.cast("string"))


def pack2bit(seq: Column) -> Column:
    """Up to 31 bases as one long, two bits each, first base highest."""
    return F.conv(F.translate(seq, BASES, "0123"), 4, 10).cast("long")


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement: equal for both strands."""
    return F.least(kmer, revcomp(kmer))


def explode_windows(df: DataFrame, length: int, seq: str = "seq", pos: str = "pos", window: str = "window", first: int = 1) -> DataFrame:
    """A row for each window of ``length`` bases that starts at ``first`` or later; drops seq.

    Tiles overlap by length - 1, so each window lies in one tile and is cut from a short string.
    """
    keep = [c for c in df.columns if c != seq]
    starts = F.when(F.length(seq) >= length + first - 1, F.sequence(F.lit(first), F.length(seq) - length + 1, F.lit(TILE)))
    tiles = df.select(*keep, seq, F.explode(starts).alias("_from")).select(*keep, "_from", F.substring(F.col(seq), F.col("_from"), F.lit(TILE + length - 1)).alias("_tile"))
    offsets = F.sequence(F.lit(1), F.length("_tile") - length + 1)
    return tiles.select(*keep, "_from", "_tile", F.explode(offsets).alias("_at")).select(
        *keep, (F.col("_from") + F.col("_at") - 1).alias(pos), F.substring(F.col("_tile"), F.col("_at"), F.lit(length)).alias(window)
    )


#: Letters of the texts whose segments are handed on together.
LOT = 1 << 21


def segments_of_acgt(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Maximal runs of ACGT with the offset (0-based) of each in the whole, for sequences with other letters. One pass along each sequence."""
    keep = [c for c in df.columns if c != seq]
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), f"`{seq}` string", "offset int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile("[ACGT]+").finditer
        for batch in batches:
            rows, cut, offset, held = [], [], [], 0

            def emit() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in batch.columns[1:]), pa.array(cut, pa.string()), pa.array(offset, pa.int32())], [*keep, seq, "offset"])

            for i, text in enumerate(batch.column(0).to_pylist()):
                for m in find(text or ""):
                    rows.append(i)
                    cut.append(m.group())
                    offset.append(m.start())
                held += len(text or "")
                if held >= LOT:
                    yield emit()
                    rows, cut, offset, held = [], [], [], 0
            if rows:
                yield emit()

    return df.select(F.upper(seq).alias(seq), *keep).mapInArrow(run, kinds)


def translate_codons(seq: Column, code: str = STANDARD_CODE) -> Column:
    """Amino acids of the whole codons of a sequence; codons with other letters give X."""
    codons = [a + b + c for a in CODON_BASES for b in CODON_BASES for c in CODON_BASES]
    table = F.create_map(*(F.lit(x) for pair in zip(codons, code) for x in pair))
    cut = F.regexp_extract_all(F.upper(seq), F.lit("(.{3})"), F.lit(1))
    return F.array_join(F.transform(cut, lambda c: F.coalesce(F.element_at(table, c), F.lit("X"))), "")


def wrap(seq: Column, width: int = 60) -> Column:
    """FASTA lines."""
    return F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))
