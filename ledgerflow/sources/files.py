"""File scans.

CSV is read with an explicit schema whenever one is known: schema inference
is a full extra pass over the input and is never used here. With
``header=True`` and no schema, every column is a string (the reference's
behaviour); the header is only read from the first file.

A plain typed read is permissive: a line with too few or too many fields, or
with a value that is not of its type, gives NULLs. ``read_csv_checked`` keeps
such lines, word for word, with where they came from and what is wrong.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Iterable[str]) -> T.StructType:
    """All-string nullable schema for the given column names."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


_SIMPLE_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def typed_schema(columns: Mapping[str, str | T.DataType]) -> T.StructType:
    """Nullable schema from ``{name: type}``; types are names or DataTypes."""
    fields = []
    for name, dtype in columns.items():
        if isinstance(dtype, str):
            dtype = _SIMPLE_TYPES.get(dtype.lower()) or T.DataType.fromDDL(dtype)
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    header: bool = True,
    sep: str = ",",
    schema: T.StructType | None = None,
    columns: Iterable[str] | None = None,
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
    **options: str,
) -> DataFrame:
    """Read delimited text.

    - ``header=True`` without schema: names from the header, all strings (S1/S1b).
      A UTF-8 byte-order mark at the start of the file is dropped by Spark.
    - ``schema=`` (or ``columns=`` for an all-string schema): typed read,
      header optional (S2). Malformed values become NULL in PERMISSIVE mode.
    Empty fields are read as NULL.
    """
    if schema is None and columns is not None:
        schema = string_schema(columns)
    reader = (
        spark.read.option("header", str(header).lower())
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", mode)
        .option("inferSchema", "false")
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


#: Columns that a checked read adds: for a malformed line the line itself, its
#: file and the first byte of the block of the file that it was read in; for a
#: good line NULLs.
LINE, FILE, BLOCK = "__lf_line", "__lf_file", "__lf_block"
ORIGIN = [LINE, FILE, BLOCK]


def malformed_reason(line: Column, schema: T.StructType, options: Mapping[str, str]) -> Column:
    """What is wrong with a line: "wrong number of fields", or the columns
    whose values are not of their types."""
    options = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    # the same line as text columns: malformed only by its number of fields
    texts = ", ".join(f"c{i} STRING" for i in range(len(schema))) + ", bad STRING"
    as_text = F.from_csv(line, texts, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    typed = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    as_typed = F.from_csv(line, typed.simpleString()[len("struct<"):-1].replace(":", " "), {**options, "mode": "PERMISSIVE"})
    wrong = [F.when(as_text[f"c{i}"].isNotNull() & as_typed[f"c{i}"].isNull(), F.lit(f.name)) for i, f in enumerate(schema)]
    return F.when(as_text["bad"].isNotNull(), F.lit("wrong number of fields")).otherwise(F.concat(F.lit("malformed value: "), F.concat_ws(", ", *wrong)))


@dataclass
class CheckedRead:
    """A file read with its malformed lines: ``all_rows`` has the schema's
    columns and ``ORIGIN``, one row a line."""

    all_rows: DataFrame
    schema: T.StructType
    options: Mapping[str, str]

    @property
    def rows(self) -> DataFrame:
        """The well-formed lines."""
        return self.all_rows.where(F.col(LINE).isNull()).select(*[F.col(f"`{c}`") for c in self.schema.fieldNames()])

    @property
    def malformed(self) -> DataFrame:
        """(line, file, block, reason) of every other line."""
        return malformed_lines(self.all_rows, self.schema, self.options)


def malformed_lines(df: DataFrame, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    """(line, file, block, reason) of the rows of ``df`` that have ``ORIGIN``."""
    reason = malformed_reason(F.col(LINE), schema, options)
    return df.where(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"), F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), reason.alias("reason"))


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
    **options: str,
) -> CheckedRead:
    """Read delimited text so that no line is lost.

    A line is malformed when its number of fields differs from the schema's or
    a set field is not of its column's type. It is found while the file is read
    once; no line is parsed twice except the malformed ones, for the reason.
    All columns are parsed whatever is selected later, as a pruned read does
    not see the fields it skips.
    """
    how = {"sep": sep, "encoding": encoding, **options}
    full = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    df = read_csv(spark, path, header=header, sep=sep, schema=full, encoding=encoding, columnNameOfCorruptRecord=LINE, **options)
    # always true, but it names every column: all of them are parsed
    whole = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()]), F.lit(1)) == 0
    df = df.withColumn(LINE, F.when(F.col(LINE).isNotNull() & whole, F.col(LINE)))
    bad = F.col(LINE).isNotNull()
    df = df.select("*", F.when(bad, F.col("_metadata.file_path")).alias(FILE), F.when(bad, F.col("_metadata.file_block_start")).alias(BLOCK))
    return CheckedRead(df, schema, how)


def read_parquet(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet scan (S3). Selecting ``columns`` here lets the scan prune."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if columns is not None:
        df = df.select(*columns)
    return df
