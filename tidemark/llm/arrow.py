"""Column-wise Python work inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

Step = Callable[..., list[pa.Array]]

ROWS = 512  # handled at once: bounds the Python objects, whatever the size of Spark's batches


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def named(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_arrow(
    df: DataFrame, keep: list[str], inputs: list[Column], fields: list[T.StructField],
    make: Callable[[], Step],
) -> DataFrame:
    """The columns ``keep`` and new ones computed from ``inputs``, batch by batch.

    ``make`` runs once per task and returns a function from one list per input to one Arrow array
    per new field. Rows neither move nor change their number.
    """
    source = df.select(
        *[named(c).alias(f"k{i}") for i, c in enumerate(keep)],
        *[c.alias(f"in{i}") for i, c in enumerate(inputs)],
    )
    # Plain names inside: Spark resolves the input columns by name, where a dot would mean a field.
    plain = [T.StructField(f"out{i}", f.dataType) for i, f in enumerate(fields)]
    schema = T.StructType([*source.schema.fields[: len(keep)], *plain])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in slices(batches):
            given = [batch.column(i).to_pylist() for i in range(len(keep), batch.num_columns)]
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, *step(*given)], names=names)

    return source.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])
