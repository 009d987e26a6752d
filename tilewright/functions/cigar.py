"""CIGAR strings as column functions: build, simplify, and map coordinates through them. Each passes once along a string, in NumPy."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What each operation becomes; others are dropped.
SIMPLE = {"=": "M", "X": "M", "M": "M", "N": "D", "D": "D", "S": "I", "I": "I"}
_WHOLE, _EACH = re.compile("(?:[0-9]+[=XMNDSIHP])*"), re.compile("([0-9]+)([=XMNDSIHP])")
_LETTERS, _DIGITS = bytes.maketrans(b"=XMNDSIHP", b" " * 9), b"0123456789"
_TABLE = np.zeros(256, dtype=np.uint8)
_TABLE[[ord(x) for x in SIMPLE]] = [ord(x) for x in SIMPLE.values()]


def parse(cigar: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and operations (as bytes); what is not of the form is skipped."""
    if _WHOLE.fullmatch(cigar):
        text = cigar.encode()
        return np.array(text.translate(_LETTERS).split(), dtype=np.int64), np.frombuffer(text.translate(None, _DIGITS), np.uint8)
    found = _EACH.findall(cigar)
    return np.array([int(n) for n, _ in found], dtype=np.int64), np.array([ord(op) for _, op in found], dtype=np.uint8)


def _joined(n: np.ndarray, op: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours with the same operation become one."""
    if not len(op):
        return n, op
    starts = np.concatenate(([0], np.flatnonzero(op[1:] != op[:-1]) + 1))
    return np.add.reduceat(n, starts), op[starts]


def _simple(cigar: str) -> tuple[np.ndarray, np.ndarray]:
    n, op = parse(cigar)
    op = _TABLE[op]
    return _joined(n[op > 0], op[op > 0])


def text(n: np.ndarray, op: np.ndarray) -> str:
    return "".join([f"{k}{c}" for k, c in zip(n.tolist(), op.tobytes().decode())])


def simplify(cigar: Column) -> Column:
    """Only M, D and I, equal neighbours joined."""

    @F.pandas_udf("string")
    def run(cigars: pd.Series) -> pd.Series:
        return cigars.map(lambda c: None if c is None else text(*_simple(c))).astype(object)

    return run(cigar)


def _letters(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), "<u4")


def build_one(query: str, reference: str) -> str:
    q, r = _letters(query), _letters(reference)
    wide = max(len(q), len(r))
    q, r = (np.concatenate((x, np.zeros(wide - len(x), dtype=x.dtype))) for x in (q, r))
    no_q, no_r = q == ord("-"), r == ord("-")
    op = np.select([no_q, no_r, q == r], [ord("D"), ord("I"), ord("=")], ord("X")).astype(np.uint8)[~(no_q & no_r)]
    return text(*_joined(np.ones(len(op), dtype=np.int64), op))


def build(query: Column, reference: Column) -> Column:
    """CIGAR of one row of an alignment against another of equal length: = equal, X unequal, D gap in query, I gap in reference; both gaps are skipped."""

    @F.pandas_udf("string")
    def run(queries: pd.Series, references: pd.Series) -> pd.Series:
        return pd.Series([None if q is None or r is None else build_one(q, r) for q, r in zip(queries, references)], dtype=object)

    return run(query, reference)


def adjusted(pos: np.ndarray, cigar: str, greedy: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """adjust for many positions, through one pass along the CIGAR, and which of them are not beyond it."""
    n, op = _simple(cigar)
    m, d = op == ord("M"), op == ord("D")
    on = np.flatnonzero(m | d)
    cons, own = np.cumsum(np.where(m | d, n, 0)), np.cumsum(np.where(d, 0, n))
    out = np.zeros(len(pos), dtype=np.int64)
    at = np.searchsorted(cons[on], pos)
    inside = at < len(on)
    k = on[at[inside]]
    out[inside] = own[k] - np.where(m[k], n[k], 0) + np.where(m[k], pos[inside] - (cons[k] - n[k]), 1 if greedy else 0)
    return out, inside


def adjust_all(positions: Column, cigar: Column, greedy: bool = False) -> Column:
    """Positions on the consensus (array, 1-based) -> on the sequence (array), null for those beyond it."""

    @F.pandas_udf("array<int>")
    def run(every: pd.Series, cigars: pd.Series) -> pd.Series:
        out = []
        for some, c in zip(every, cigars):
            if some is None or c is None:
                out.append(None)
                continue
            known = [p for p in some if p is not None and p == p]
            found, inside = adjusted(np.array(known, dtype=np.int64), c, greedy)
            each = iter([x if ok else None for x, ok in zip(found.tolist(), inside.tolist())])
            out.append([next(each) if p is not None and p == p else None for p in some])
        return pd.Series(out, dtype=object)

    return run(positions, cigar)


def adjust(pos: Column, cigar: Column, greedy: bool = False) -> Column:
    """A position on the consensus (1-based) -> on the sequence. In a deletion: the base before it, or with greedy the one after."""
    return adjust_all(F.array(pos.cast("int")), cigar, greedy)[0]
