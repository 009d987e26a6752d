"""What Python stages share: shipping the package to executors, Arrow helpers, and the letters of byte-level vocabularies.

The session's settings are left alone. Stages cut what they get into pieces (``groups``); where executors have little memory, set
``spark.sql.execution.arrow.maxBytesPerBatch`` below Spark's 64 MB.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: ASCII punctuation: neither letters, digits nor white space.
TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def letters_of_bytes() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself if printable, else from U+0100 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "tilewright_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def spans(lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of consecutive pieces."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return (ends - lengths).tolist(), ends.tolist()


def groups(batches, column: str, limit: int = 8 << 20):
    """Record batches cut into pieces of about ``limit`` bytes of one column, at least a row each; bounds what a stage holds at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield batch.slice(i, j - i)
