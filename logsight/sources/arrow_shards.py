"""Reading of existing Arrow/Feather shard files from any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SUFFIXES = (".arrow", ".feather")


def scan_shards(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The wanted columns of all shards by name, absent ones NULL; types are made to fit.

    Spark fetches the files, so paths may have any scheme that it knows, and deals them out to tasks; a task
    holds one shard at a time (of at most 2 GB) and decodes only the wanted columns of one record batch after
    the other.
    """
    wanted = to_arrow_schema(schema)

    def batches(found: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for content in found.column(0):
            source = pa.BufferReader(content.as_buffer())
            names = pa.ipc.open_file(source).schema.names
            picked = [names.index(n) for n in wanted.names if n in names]
            source.seek(0)
            shard = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=picked or [0]))
            for i in range(shard.num_record_batches):
                batch = shard.get_batch(i)
                present = set(batch.schema.names)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(f.name).cast(f.type) if f.name in present else pa.nulls(batch.num_rows, f.type)
                        for f in wanted
                    ],
                    schema=wanted,
                )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in rows:
            for i in range(found.num_rows):
                yield from batches(found.slice(i, 1))

    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, schema)


def write_shards(df: DataFrame, folder: str, codec: str = "lz4") -> DataFrame:
    """Write a frame as shards, one a task, to a folder that tasks reach by Arrow's file systems; their paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place)
        name = f"{place}/shard-{TaskContext.get().partitionId():06d}.arrow"
        writer = None
        with system.open_output_stream(name) as out:  # a task that runs again replaces its shard
            for batch in batches:
                if writer is None:
                    writer = pa.ipc.new_file(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec))
                writer.write_batch(batch)
            if writer is None:
                writer = pa.ipc.new_file(out, to_arrow_schema(schema))
            writer.close()
        yield pa.RecordBatch.from_pydict({"path": [name]})

    schema = df.schema
    return df.mapInArrow(run, "path string")
