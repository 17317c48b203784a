"""Rows of damaged Parquet files: what can be read is, row group by row group, and what is lost is counted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def binary_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, content) of files; one file is held by one task."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def _read(batches: Iterator[pa.RecordBatch], wanted: pa.Schema) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    whole = pa.schema([*wanted, pa.field("_path", pa.string()), pa.field("_group", pa.int32()), pa.field("_lost", pa.int64()), pa.field("_error", pa.string())])

    def note(path: str, group: int | None, lost: int | None, error: Exception) -> pa.RecordBatch:
        values = [None] * len(wanted) + [path, group, lost, f"{type(error).__name__}: {str(error)[:200]}"]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, whole, strict=True)], schema=whole)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()), page_checksum_verification=True)
            except (pa.ArrowException, OSError) as error:  # no footer: nothing says what the file held
                yield note(path, None, None, error)
                continue
            for group in range(file.num_row_groups):
                try:
                    table = file.read_row_group(group, [f.name for f in wanted if f.name in file.schema_arrow.names])
                    table = pa.table([table[f.name].cast(f.type) if f.name in table.column_names else pa.nulls(table.num_rows, f.type) for f in wanted], schema=wanted)
                except (pa.ArrowException, OSError) as error:
                    yield note(path, group, file.metadata.row_group(group).num_rows, error)
                    continue
                for part in table.to_batches(max_chunksize=10_000):
                    ends = [pa.array([path] * part.num_rows), pa.array([group] * part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *ends], schema=whole)


def salvage(files: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, lost): the rows that can be read from ``files`` (path, content), and what cannot be.

    A row group is read as a whole or not at all: pages whose checksum is wrong fail it. Columns that a
    file lacks are null, values that do not fit the ``schema`` fail their group. ``lost`` has path, group,
    the number of its rows and the error; a file without a readable footer has neither group nor number.
    """
    wanted = to_arrow_schema(files.sparkSession.createDataFrame([], schema).schema)
    found = files.mapInArrow(lambda b: _read(b, wanted), f"{schema}, _path string, _group int, _lost long, _error string")
    columns = [f.name for f in wanted]
    lost = found.where("_error IS NOT NULL").select(F.col("_path").alias("path"), F.col("_group").alias("group"), F.col("_lost").alias("n_rows"), F.col("_error").alias("error"))
    return found.where("_error IS NULL").select(*columns), lost
