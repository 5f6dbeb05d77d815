"""CSV files of records and statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitarium.fixed import RECORD_COLUMNS
from vitarium.schema import RECORD


#: Holds the raw line of a row whose number of cells is not that of the header.
_ODD = "__odd_row"


def read_records(spark: SparkSession, path: str, *, schema: T.StructType | None = None, multi_line: bool = True,
                 mixed_headers: bool = False, position: bool = False) -> DataFrame:
    """Records of CSV files with a header; absent cells are empty, all-empty rows dropped.

    All files are read once and must have one header; a file with another fails the read by name.  With
    ``mixed_headers`` files are grouped by their header first, which takes a second look at every
    file, read group by group and united by column name.  Without ``schema`` every column is text.

    Line breaks inside quotes are part of a cell, so one task reads one whole file.  For large files without
    any, ``multi_line=False`` lets tasks share a file; a row that a quoted line break has torn apart is
    then an error.  ``position`` adds ``file_path``, ``file_block`` and ``row_no``, which order the rows of one read.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "enforceSchema": False}

    def read(paths: list[str] | str) -> DataFrame:
        reader = spark.read.options(**options)
        found = reader.csv(paths)
        if not multi_line:
            names = found.schema.names
            found = reader.schema(T.StructType([*found.schema.fields, T.StructField(_ODD, T.StringType())])).option(
                "columnNameOfCorruptRecord", _ODD).csv(paths)
            torn = F.length(_ODD) - F.length(F.replace(_ODD, F.lit('"'), F.lit("")))
            problem = F.concat(F.lit("a line break inside quotes tears this row apart, read with multi_line: "), _ODD)
            # the check stands in the first column, so no plan can leave it out
            first = F.when(F.coalesce(torn % 2, F.lit(0)) == 1, F.raise_error(problem).cast("string")).otherwise(F.col(f"`{names[0]}`"))
            found = found.select("*", first.alias("__first")).withColumn(names[0], F.col("__first")).drop("__first", _ODD)
        if position:
            found = found.select("*", F.col("_metadata.file_path").alias("file_path"),
                                 F.col("_metadata.file_block_start").alias("file_block"))
        return found

    layouts = _layouts(spark, path) if mixed_headers else {}
    tables = [read(files) for files in layouts.values()] if len(layouts) > 1 else [read(path)]
    df = tables[0]
    for other in tables[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    places = ["file_path", "file_block"] if position else []
    fields = schema.fields if schema is not None else [f for f in df.schema if f.name not in places]
    any_filled = F.lit(False)
    columns = []
    for field in fields:
        value = F.coalesce(F.col(f"`{field.name}`"), F.lit("")) if field.name in df.columns else F.lit("")
        any_filled = any_filled | (value != "")
        if not isinstance(field.dataType, T.StringType):
            value = F.nullif(value, F.lit("")).cast(field.dataType)
        columns.append(value.alias(field.name))
    rows = df.filter(any_filled).select(*columns, *places)
    return rows.withColumn("row_no", F.monotonically_increasing_id()) if position else rows


def _layouts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files below ``path`` by header line; one row a file reaches the driver.

    A header is the first line of its file.  Finding it reads every file once more.
    """
    name, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select(name.alias("file"), start.alias("start"), "value",
                                                          F.monotonically_increasing_id().alias("at"))
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    return {r.header: sorted(r.files) for r in sorted(found, key=lambda r: r.header)}


def write_records(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """CSV with a header, even without rows; quotes only where needed; NULL is empty."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def aligned_columns(schemas: Sequence[Sequence[str]], base: Sequence[str] = RECORD_COLUMNS) -> list[str]:
    """The distinct columns of several tables; without any, those of ``base``.

    Record columns that ``base`` names come first and in record order, then the rest of
    ``base``, then what only the tables have, in the order met.
    """
    known = {name: place for place, name in enumerate(sorted(base, key=_record_place))}
    met = {name: None for columns in schemas for name in columns} or known
    return sorted(met, key=lambda name: known.get(name, len(known)))


def _record_place(name: str) -> int:
    return RECORD_COLUMNS.index(name) if name in RECORD_COLUMNS else len(RECORD_COLUMNS)


def align_columns(tables: Sequence[DataFrame], base: Sequence[str] = RECORD_COLUMNS) -> DataFrame:
    """Union of tables of differing columns, in aligned order; absent columns are NULL."""
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union.select(*aligned_columns([t.columns for t in tables], base))


def empty_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECORD)
