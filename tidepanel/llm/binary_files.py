"""Binary files written and read by Spark itself.

Executors write through Spark's text writer, so files reach any store that Spark
reaches and its commit protocol covers lost and repeated tasks. A row is a byte
string, written as it is and followed by the writer's line separator; a file
format built on this either has a place for those bytes or skips them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(rows: DataFrame, blocks: Callable[[Iterator[pd.DataFrame]], Iterator[bytes]],
                path: str, separator: str) -> None:
    """One file for each partition of `rows`: its blocks in order."""
    def out(batches):
        held, size = [], 0
        for b in blocks(batches):
            held.append(b)
            size += len(b)
            if size >= 4_000_000:
                yield pd.DataFrame({"value": held})
                held, size = [], 0
        if held:
            yield pd.DataFrame({"value": held})

    (rows.mapInPandas(out, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", separator).text(path))


def read_files(spark: SparkSession, path: str, rows_of: Callable[[str, bytes], Iterator[pd.DataFrame]],
               schema: str) -> DataFrame:
    """Rows that `rows_of(file name, content)` finds; a task holds one file at a time
    beside the batch it came in, so writers keep files small."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select("path", "content"))

    def out(batches):
        for frame in batches:
            for name, content in zip(frame["path"], frame["content"]):
                if content:
                    yield from rows_of(name.rsplit("/", 1)[-1], bytes(content))

    return files.mapInPandas(out, schema)
