"""File sources and sinks."""

import re
from urllib.parse import unquote

from pyspark.sql import functions as F

from estimand.functions.columns import null_fill

# Column type names accepted by the CSV importer.
CSV_TYPES = {int: "bigint", float: "double", str: "string"}

def read_parquet(spark, path):
    return spark.read.parquet(path)


def read_columnar_text(spark, path, fmt, schema=None, glob=None, **options):
    """ORC or text/CSV warehouse files, optionally restricted by a file glob."""
    if fmt not in ("orc", "text", "csv", "parquet"):
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_partitions(spark, path, column, partitions, fmt="parquet"):
    """Only the listed partitions (pruned by Catalyst); a missing one raises."""
    df = spark.read.format(fmt).load(path)
    wanted = [str(p) for p in partitions]
    # partition values come from directory names, no data file is read
    present = {unquote(v) for f in df.inputFiles() for v in re.findall(f"/{re.escape(column)}=([^/]*)/", f)}
    missing = [p for p in wanted if p not in present]
    if missing:
        raise ValueError(f"partitions not found: {missing}")
    return df.where(F.col(column).isin(list(partitions)))


def import_csv(spark, path, columns, header=True):
    """CSV with a header; ``columns`` maps names to int, float or str, columns
    not listed stay strings."""
    raw = spark.read.option("header", header).csv(path)
    unknown = [c for c in columns if c not in raw.columns]
    if unknown:
        raise ValueError(f"columns not in the file: {unknown}")
    return raw.select(*[
        F.col(c).cast(CSV_TYPES[columns[c]]).alias(c) if c in columns else F.col(c) for c in raw.columns
    ])


def export_csv(df, path, mode="errorifexists"):
    """All rows as CSV, one file with a header for each partition."""
    df.write.mode(mode).option("header", True).csv(path)


def size_guard(df, max_rows=None, max_files=None, max_bytes=None):
    """Raise when a transfer exceeds a limit that the caller sets; without limits nothing is counted.

    Files and bytes are only known for frames read straight from files.
    """
    if (max_files is not None or max_bytes is not None) and "_metadata" not in df.columns and df.inputFiles():
        files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
        seen = files.agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("size")).first()
        if max_files is not None and seen["n"] > max_files:
            raise ValueError(f"{seen['n']} files exceed the limit of {max_files}")
        if max_bytes is not None and (seen["size"] or 0) > max_bytes:
            raise ValueError(f"{seen['size']} bytes exceed the limit of {max_bytes}")
    if max_rows is not None:
        rows = df.count()
        if rows > max_rows:
            raise ValueError(f"{rows} rows exceed the limit of {max_rows}")
    return df


def import_table(df, keep_nulls=False):
    """Import-time null policy of the reference (0 and 'null')."""
    return df if keep_nulls else null_fill(df)


def peek(df, partition=None, values=(), n=10):
    """First rows of the selected partitions."""
    return (df.where(F.col(partition).isin(list(values))) if partition else df).limit(n)
