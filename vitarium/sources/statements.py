"""Statement files: CSV for review, QuickStatements for upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from vitarium.operators.occupations import quickstatements, statement_columns
from vitarium.operators.records import Seq
from vitarium.operators.skew import seq_columns
from vitarium.sources.csv_files import write_records


def write_statements(df: DataFrame, path: str, *, record_id: Seq, mode: str = "errorifexists") -> None:
    """Statement CSV; rows are ordered by record and rank within each part file, which is all that
    either format needs."""
    ordered = df.sortWithinPartitions(*seq_columns(record_id), "rank")
    write_records(statement_columns(ordered), path, mode=mode)


def write_quickstatements(df: DataFrame, path: str, *, record_id: Seq, retrieved: Column | None = None,
                          mode: str = "errorifexists") -> None:
    """One QuickStatements line per statement, ordered by record and rank within each part file."""
    quickstatements(df.sortWithinPartitions(*seq_columns(record_id), "rank"), retrieved).write.mode(mode).text(path)
