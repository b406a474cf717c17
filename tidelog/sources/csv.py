"""CSV with headers and a stated schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False
) -> DataFrame:
    """Read the schema's columns by header name; further columns are not parsed.

    Spark takes the first file's header for all files, so files are read together only if
    their headers are the same; that costs a look at the first line of each file. Nothing
    is inferred: a zip code `01151` stays text, and a value that does not fit its type
    fails the job. `multi_line` allows line breaks inside quotes; such a file is read by
    one task.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in reader.csv(path).inputFiles():
        by_header.setdefault(tuple(reader.csv(file).columns), []).append(file)
    parts = [
        raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        for raw in (reader.csv(files) for files in by_header.values())
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
