"""Text file output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_documents(
    df: DataFrame, path: str, column: str, docs_per_file: int = 10_000, mode: str = "errorifexists"
) -> None:
    """Write one text per document, a new file after ``docs_per_file`` of them.

    Each text ends with its own newline, so rows are joined by nothing more
    than an empty line.  Documents without text are skipped.
    """
    texts = df.where(F.length(column) > 0).select(F.col(column).alias("value"))
    writer = texts.write.mode(mode).option("maxRecordsPerFile", docs_per_file)
    writer.option("lineSep", "\n").text(path)


def write_vertical(df: DataFrame, path: str, docs_per_file: int = 10_000, mode: str = "errorifexists") -> None:
    """Write the ``vertical`` text of documents."""
    write_documents(df, path, "vertical", docs_per_file, mode)


def write_conll(df: DataFrame, path: str, docs_per_file: int = 10_000, mode: str = "errorifexists") -> None:
    """Write the ``conll`` text of documents."""
    write_documents(df, path, "conll", docs_per_file, mode)
