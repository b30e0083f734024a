from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.functions.numbers import malformed, to_integer

REJECT_COLUMNS = ("file", "line", "column", "reason")


def read_delimited(
    spark: SparkSession, path: str, sep: str = ";", columns: Sequence[str] | None = None
) -> DataFrame:
    """Delimited text with a header line, every column as string.

    Without ``columns`` the names come from the header. With ``columns`` (in file
    order) no file is touched before the first action. Either way a file whose header
    does not agree is an error: columns are never matched by position alone.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stored table, with its columns in the order of ``schema``.

    JSON lines need the schema: an inferred one sorts the columns, widens the ints,
    loses a column that is null everywhere and costs a pass over the files. Leave it
    out only to ask for just that.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.format(fmt).load(path)
    if schema is None:
        return table
    # A partition column is moved to the end by the file source.
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    return table.select(*names)


def read_rejects(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    sep: str = ";",
    numbers: Sequence[str] = (),
    integers: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """``(file, line, column, reason)``: what ``read_delimited`` and cleaning would make null or fail on.

    A line with too few or too many fields has the reason ``fields``, no column, and its raw text. Each of
    ``numbers`` that ``clean_number`` cannot read, and of ``integers`` that ``to_integer`` cannot, is a row with
    the reason ``number`` or ``integer``; its line is put together again from the fields, without quotes. Empty fields
    are no rejects. Headers are checked in every file.
    """
    corrupt = "__line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, corrupt)])
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).schema(schema).csv(path)

    def reject(test, column: str | None, reason: str):
        return F.when(test, F.struct(F.lit(column).cast("string").alias("column"), F.lit(reason).alias("reason")))

    whole = F.col(corrupt).isNull()
    found = [reject(~whole, None, "fields")]
    found += [reject(whole & malformed(F.col(c), strict), c, "number") for c in numbers]
    found += [reject(whole & F.col(c).isNotNull() & to_integer(F.col(c)).isNull(), c, "integer") for c in integers]
    text = F.coalesce(corrupt, F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in columns]))
    listed = rows.select(F.col("_metadata.file_path").alias("file"), text.alias("line"), F.array_compact(F.array(*found)).alias("found"))
    return listed.select("file", "line", F.inline("found"))
