"""Python steps over Arrow batches, and texts as flat byte arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows are handed to a step in slices of about this much text.
SLICE_BYTES = 4 << 20


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and where each begins; nulls are empty."""
    kind = pa.binary() if pa.types.is_binary(column.type) else pa.string()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(pa.scalar(b"" if kind == pa.binary() else "", kind))
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(
        1, np.int32)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), starts.astype(np.int64)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``SLICE_BYTES`` of the column; a longer text stays whole."""
    _, starts = flat_texts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(starts, starts[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def map_texts(df: DataFrame, keep: list[str], text: str, fields: list[tuple[str, str]],
              step: Callable[[pa.Array], list]) -> DataFrame:
    """Columns ``keep`` followed by what ``step`` makes of the texts of each slice of rows.

    ``step`` gets an Arrow array and returns one array per field.  Columns are handed over
    by place, so names may be anything.
    """
    source = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("text"))
    new = [T.StructField(f"f{i}", T._parse_datatype_string(kind)) for i, (_, kind) in enumerate(fields)]
    schema = T.StructType(source.schema.fields[:-1] + new)
    types = [_arrow(f.dataType) for f in new]
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                made = [pa.array(x, t) if not isinstance(x, pa.Array) else x
                        for x, t in zip(step(part.column(part.num_columns - 1)), types)]
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + made, names=names)

    return source.mapInArrow(run, schema).toDF(*keep, *(name for name, _ in fields))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind, prefers_large_types=False)
