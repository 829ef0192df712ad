"""Python functions over Arrow batches, for what Spark's own functions can't express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def text_pass(change: Callable[[str], str]) -> Callable[[Column], Column]:
    """``change`` as a pass over a column of text; null stays null."""

    def batches(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([None if t is None else change(t) for t in part.to_pylist()], pa.string())

    batches.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return lambda c: F.arrow_udf(batches, "string")(c)  # made when it is used: a session must exist


def rows_pass(change: Callable, ddl: str, kind: pa.DataType) -> Callable[..., Column]:
    """``change`` of the values of several columns, row by row within a batch."""

    def batches(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for part in parts:
            part = part if isinstance(part, tuple) else (part,)  # a single column comes by itself
            yield pa.array([change(*values) for values in zip(*(p.to_pylist() for p in part), strict=True)], kind)

    batches.__annotations__ = {"parts": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return lambda *cs: F.arrow_udf(batches, ddl)(*cs)
