"""File sources and sinks: typed CSV reads, stage hand-off, split writes.

The reference hands data between notebooks as headered CSV files that the
next step re-reads under a declared schema.  Those semantics are kept
(positional schema, tolerant parsing, header-only string reads), and
Parquet is offered as the default stage format because it keeps types and
lets Catalyst push filters and column selections into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: Written for a null, so that an empty string stays one; no escaped text can equal it.
NULL_CELL = "\\N"


def _escaped(c: Column) -> Column:
    """Text on one line: backslash, line feed and carriage return as two-character escapes."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(c: Column) -> Column:
    """The text that :func:`_escaped` was given: pairs are split off first, so each escape is read once."""
    parts = F.split(c, r"\\\\", -1)
    plain = F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


class HeaderMismatchError(ValueError):
    """The file header does not name the schema's columns in order."""


def read_header(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Column names from the first line of the CSV data at ``path``.

    Reads a single line (``limit(1)``), so the cost does not depend on the
    size of the files.
    """
    first = (spark.read.option("header", False).option("sep", sep).option("encoding", encoding)
             .csv(path).limit(1).collect())
    return [] if not first else [v for v in first[0]]


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True,
                   mode: str = "PERMISSIVE", corrupt_col: str | None = None, check_header: bool = False,
                   encoding: str = "UTF-8", sep: str = ",", staged: bool = False) -> DataFrame:
    """Read CSV with a declared schema (or, with ``schema=None``, all strings).

    * The schema applies **by position**, as Spark does by default: a file
      wider than the schema loses its surplus columns.
    * ``mode="PERMISSIVE"`` turns a cell that does not parse (``NA`` in an
      integer column) into null; ``corrupt_col`` additionally keeps the raw
      line of such rows in a string column.  ``FAILFAST`` raises instead.
    * ``check_header=True`` compares a header line with the schema's leading
      field names at once and raises :class:`HeaderMismatchError` on a
      difference (surplus trailing columns are allowed); the header of every
      other file must equal it, which the tasks check as they open the files.
    * ``staged=True`` reads what :func:`write_stage` wrote: its nulls, empty
      strings and escaped line ends come back as they were.
    """
    reader = spark.read.option("header", header).option("encoding", encoding).option("sep", sep).option("mode", mode)
    if schema is not None:
        if corrupt_col is not None:
            if corrupt_col not in schema.fieldNames():
                schema = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        reader = reader.schema(schema)
    if staged:
        reader = reader.option("nullValue", NULL_CELL).option("escape", '"')
    wanted = None
    if check_header and header and schema is not None:
        wanted = schema.fieldNames()
        expected = [c for c in wanted if c != corrupt_col]
        found = read_header(spark, path, sep=sep, encoding=encoding)
        if found[: len(expected)] != expected:
            raise HeaderMismatchError(f"header {found} does not start with schema columns {expected}")
        # all columns are named, so that each file's header can be held against them
        surplus = [StructField(c, StringType()) for c in found[len(expected):]]
        own = [f for f in schema.fields if f.name != corrupt_col]
        reader = (reader.option("enforceSchema", False).option("columnPruning", False)
                  .schema(StructType(own + surplus + [f for f in schema.fields if f.name == corrupt_col])))
    out = reader.csv(path)
    if wanted is not None:
        out = out.select(*[F.col(f"`{c}`") for c in wanted])
    if staged:
        text = [f.name for f in out.schema.fields if isinstance(f.dataType, StringType) and f.name != corrupt_col]
        out = out.withColumns({c: _unescaped(F.col(f"`{c}`")) for c in text})
    return out


def typed_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast string columns to declared types with ``try_cast``: bad text → null.

    The reference sums a string column and relies on an implicit cast,
    which fails under ANSI mode on text such as a repeated header line;
    casting explicitly at the source keeps every later expression typed.
    """
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Write a stage table (Parquet by default, CSV with header on request).

    CSV stages keep strings as they are: nulls, empty strings, padding,
    quotes and line ends differ in the file and come back through
    ``read_typed_csv(staged=True)`` or :func:`read_stage`; a line stays a
    row, so the files can still be split.
    """
    if fmt == "csv":
        df = _one_line_cells(df, partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        _faithful(writer, header).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def _one_line_cells(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in keys]
    return df.withColumns({c: _escaped(F.col(f"`{c}`")) for c in text}) if text else df


def _faithful(writer: DataFrameWriter, header: bool) -> DataFrameWriter:
    return (writer.option("header", header).option("nullValue", NULL_CELL).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_stage(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet",
               header: bool = True) -> DataFrame:
    """Re-read a stage table written by :func:`write_stage`."""
    if fmt == "csv":
        return read_typed_csv(spark, path, schema=schema, header=header, staged=True)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def split_write(df: DataFrame, path: str, by: Sequence[str] | str, fmt: str = "csv", header: bool = True,
                mode: str = "append", files_per_value: int | None = None,
                max_records_per_file: int | None = None) -> str:
    """Write one folder per distinct value of ``by`` in a single job.

    The reference loops over distinct values on the driver and writes one
    filtered, single-task copy per value; here a single ``partitionBy``
    write does it.

    * Default: no shuffle — every input task writes its own file for each
      value it holds, so the write is exactly as parallel as the scan (at
      the cost of up to tasks × values files; ``max_records_per_file`` caps
      file size).
    * ``files_per_value=s``: rows are shuffled so that each value is written
      by ``s`` tasks, chosen by a deterministic hash of the whole row (a
      retried task writes the same rows again).  This bounds the file count
      to values × ``s``; size ``s`` to the largest value's bytes divided by
      the target file size, so a value holding a third of the data is still
      split into many tasks.
    """
    keys = [by] if isinstance(by, str) else list(by)
    # a folder name cannot tell an empty string from a null, so an empty key fails the job
    empty = F.lit("split_write: an empty string cannot name a folder; replace it first")
    text = [k for k in keys if isinstance(df.schema[k].dataType, StringType)]
    out = df.withColumns({k: F.when(F.col(f"`{k}`") == "", F.raise_error(empty)).otherwise(F.col(f"`{k}`")) for k in text})
    if fmt == "csv":
        out = _one_line_cells(out, keys)
    if files_per_value:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_value))
        out = out.repartition(*[F.col(k) for k in keys], spread)
    writer = out.write.mode(mode).partitionBy(*keys)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        _faithful(writer, header).csv(path)
    else:
        writer.format(fmt).save(path)
    return path
