"""Arrow batches inside tasks: plain byte strings in, columns out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: Rows that are in Python's hands at once; Spark's batches hold ten thousand, which are many megabytes of text.
ROWS = 500


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, without copying."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """Map every Arrow batch to columns. ``make`` runs once per task, so it can set up compressors, tables or caches."""
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in slices(batches):
            yield pa.RecordBatch.from_pydict(step(batch), schema=wanted)

    return df.mapInArrow(run, schema)


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the check sum of the id's digits leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
