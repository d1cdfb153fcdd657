"""Tables over Parquet files that a user owns."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespan.sources.errors import ExternalTableError
from lakespan.sources.names import dotted, quoted
from lakespan.sources.options import Options
from lakespan.sources.tables import MAX_LENGTH, RULES, Tables, nullable, sizes, sql_type


def columns_of(spark: SparkSession, url: str) -> tuple[T.StructType, list[str]]:
    """The columns of Parquet files and the names of those that their folders give."""
    tables, probe = Tables(spark), [f"lakespan_probe_{uuid.uuid4().hex[:12]}"]
    try:
        spark.catalog.createTable(dotted(probe), path=url, source="parquet")
        return spark.table(dotted(probe)).schema, [c.name for c in spark.catalog.listColumns(dotted(probe)) if c.isPartition]
    except Exception as e:
        raise ExternalTableError(f"{url} holds no Parquet files with columns: {str(e)[:200]}") from e
    finally:
        tables.drop(probe)


def register(spark: SparkSession, url: str, parts: list[str], known: T.StructType, strlen: int | None = None, array_length: int = 0) -> None:
    """A table over the files at url.

    The files tell the types of their own columns. Folders don't, so known must give those of partition columns.
    A column of known with maxlength bounds what later writes may put into it. A table whose rows can't be read
    isn't kept."""
    tables = Tables(spark)
    schema, by = columns_of(spark, url)
    given = {f.name.lower(): f for f in known}
    unknown = [c for c in by if c.lower() not in given]
    if unknown:
        raise ExternalTableError("columns have no type", unknown)
    fields = [given[f.name.lower()] if f.name in by else f for f in schema]
    fields = [T.StructField(f.name, f.dataType, True, {MAX_LENGTH: given[f.name.lower()].metadata[MAX_LENGTH]} if f.name.lower() in given and MAX_LENGTH in given[f.name.lower()].metadata else f.metadata) for f in fields]
    if by:
        spark.sql(f"CREATE TABLE {dotted(parts)} ({', '.join(f'{quoted(f.name)} {sql_type(spark, f.dataType)}' for f in fields)}) USING parquet PARTITIONED BY ({', '.join(map(quoted, by))}) LOCATION '{url.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}'")
    else:
        spark.catalog.createTable(dotted(parts), path=url, source="parquet", schema=nullable(T.StructType(fields)))
    try:
        if by:
            spark.catalog.recoverPartitions(dotted(parts))
        rules = sizes(T.StructType(fields), strlen, array_length)
        if any(rules.values()):
            tables.set_properties(parts, {RULES: json.dumps(rules)})
        spark.table(dotted(parts)).select([quoted(f.name) for f in fields if not isinstance(f.dataType, T.MapType)]).limit(1).collect()
    except Exception:
        tables.drop(parts)
        raise


def write_new(df: DataFrame, o: Options, parts: list[str]) -> int:
    """Write df to files of its own and register them; the number of rows."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**file_sizes(df, o)).parquet(o.staging_fs_url)
    register(df.sparkSession, o.staging_fs_url, parts, df.schema, o.strlen, o.array_length)
    return seen.get["n"]


def file_sizes(df: DataFrame, o: Options) -> dict:
    """Writer options for max_row_group_size_export_mb and max_file_size_export_mb; Spark bounds files by rows, so the
    second goes by the size that Spark expects of a row."""
    out = {"parquet.block.size": o.max_row_group_size_export_mb * 2**20}
    if o.max_file_size_export_mb != Options.max_file_size_export_mb:
        out["maxRecordsPerFile"] = max(1, o.max_file_size_export_mb * 2**20 // df._jdf.schema().defaultSize())
    return out
