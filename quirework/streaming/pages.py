"""Pages that arrive while a book is being recognised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import newlines
from ..sources.files import page_number


def arriving_pages(spark: SparkSession, directory: str) -> DataFrame:
    """A stream of book (the directory's name), page_no, text of <n>.md files; empty files don't arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.md").load(directory)
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("book"), page_number(F.element_at(parts, -1)).alias("page_no"), newlines(F.decode("content", "UTF-8")).alias("text")).where("page_no is not null")


def done_counts(pages: DataFrame) -> DataFrame:
    """Running number and last page of each book, for progress; state is one row per book."""
    return pages.groupBy("book").agg(F.count("*").alias("done"), F.max("page_no").alias("last"))
