"""Folds over the sorted rows of each key, one row after another, that never hold a key's rows at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Rows of a page that is sent on.
_PAGE = 8192


def fold_sorted(
    rows: DataFrame, key: str, order: list[str], columns: list[str], start: Callable[[], Any], step: Callable[..., tuple], schema: StructType, finish: Callable[[Any], tuple | None] | None = None
) -> DataFrame:
    """``key`` and what ``step(state, *order, *columns)`` gives for each row of a key in order; then ``finish(state)``.

    One shuffle brings a key's rows together and sorts them (Spark's sort spills); a task then reads pages and carries
    only the state, which ``start()`` makes for each key. So a key may have any number of rows, and a task needs the
    memory of a page and of one state. Nulls are a key of their own; order columns come first in the state's arguments.
    """
    names = [key, *order, *columns]
    schema = StructType([StructField(f.name, f.dataType) for f in schema])  # a key's last row may have nulls anywhere
    shape = to_arrow_schema(schema)

    def page(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        at, state, out = nothing, None, []

        def ended() -> None:
            if finish and at is not nothing and (last := finish(state)) is not None:
                out.append((at, *last))

        for batch in batches:
            for k, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is nothing or k != at:
                    ended()
                    at, state = k, start()
                out.append((k, *step(state, *values)))
                if len(out) >= _PAGE:
                    yield page(out)
                    out.clear()
        ended()
        if out:
            yield page(out)

    sorted_rows = rows.select(*names).repartition(key).sortWithinPartitions(key, *order)
    return sorted_rows.mapInArrow(run, schema)
