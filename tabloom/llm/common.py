"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(texts: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of whole texts of about so many characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most_chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def lists(flat, sizes, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of every list."""
    import numpy as np

    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def empty_like(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))
