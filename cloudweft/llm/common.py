"""What the training-data operators share."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from cloudweft.scratch import discard, shared_dir, tables, written

__all__ = ["ROWS", "SPACE_BYTES", "SPACE_CLASS", "arrow_mapped", "column", "discard", "documents", "in_pieces", "labels", "others", "schema_of", "shared_dir", "tables", "whole_row", "written"]

#: The six ASCII white-space characters that separate words, as a Java character class and as bytes.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Rows that an Arrow function takes at once, and bytes, if they are of more than one row.
ROWS = 256
BYTES = 4 << 20
#: Names of columns that pass through Python as they are.
PLAIN = re.compile("[A-Za-z_][A-Za-z0-9_]*")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def column(name: str) -> Column:
    """The column of just that name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def others(docs: DataFrame, *taken: str) -> list[str]:
    """The columns of ``docs`` but those that Spark would not tell from ``taken`` ones, as it ignores case."""
    low = {t.lower() for t in taken}
    return [c for c in docs.columns if c.lower() not in low]


def schema_of(docs: DataFrame, kept: list[str], *added: tuple[str, DataType]) -> StructType:
    own = {f.name: f.dataType for f in docs.schema.fields}
    return StructType([*(StructField(c, own[c]) for c in kept), *(StructField(name, kind) for name, kind in added)])


def arrow_mapped(docs: DataFrame, first: str, kept: list[str], compute: Callable[[Iterable[pa.Array]], Iterator[list[pa.Array]]], *added: tuple[str, DataType]) -> DataFrame:
    """The ``kept`` columns and what ``compute`` makes of the column ``first``: it takes that column's slices and gives, for
    each, the arrays of the ``added`` columns. Names from outside are set aside while Python runs, as not all of them pass."""
    # Plain names stay: to give them back would copy every row once more, which counts where a row has a very long value.
    low = {"first", *(c.lower() for c in kept)}
    plain_names = len(low) == len(kept) + 1 and all(PLAIN.fullmatch(c) for c in kept)
    inner = kept if plain_names else [f"c{i}" for i in range(len(kept))]
    own = schema_of(docs, kept)
    schema = StructType([*(StructField(i, f.dataType) for i, f in zip(inner, own, strict=True)), *(StructField(name, kind) for name, kind in added)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[pa.RecordBatch] = deque()

        def values() -> Iterator[pa.Array]:
            for batch in in_pieces(batches):
                waiting.append(batch)
                yield batch.column(0)

        for arrays in compute(values()):
            batch = waiting.popleft()
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=names)

    plain = docs.select(column(first).alias("first"), *(column(c).alias(i) for c, i in zip(kept, inner, strict=True)))
    out = plain.mapInArrow(run, schema)
    return out if plain_names else out.select(*(F.col(i).alias(c) for c, i in zip(kept, inner, strict=True)), *(name for name, _ in added))


def whole_row(docs: DataFrame) -> Column:
    return F.struct(*(column(c) for c in docs.columns))


def in_pieces(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, and of one row where values are very long, for which Python objects
    are made at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            left = [batch.slice(start, rows)]
            while left:
                part = left.pop()
                if part.num_rows > 1 and part.nbytes > BYTES:
                    half = part.num_rows // 2
                    left += [part.slice(half), part.slice(0, half)]
                else:
                    yield part
