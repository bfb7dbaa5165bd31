"""Orders: natural file order, chapter numbers, runs of page numbers, first match per index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_key(digits: Column) -> Column:
    """Sortable key of a number of any size, given by its digits."""
    d = F.ltrim(digits, F.lit("0"))
    return F.struct(F.length(d).alias("size"), d.alias("digits"))


def whole_number(digits: Column) -> Column:
    """Digits as a long, the largest one for numbers beyond it; null without digits."""
    d = F.nullif(digits, F.lit(""))
    return F.when(d.isNotNull(), F.coalesce(d.try_cast("bigint"), F.lit(2**63 - 1).cast("bigint")))


def natural_key(c: Column) -> Column:
    """Sortable key: text parts in lower case between numbers, numbers as numbers; null text sorts first."""
    parts = F.split(F.lower(c), "[0-9]+")
    numbers = F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), number_key)
    return F.transform(F.arrays_zip(parts.alias("t"), numbers.alias("i")), lambda z: F.struct(z["t"].alias("t"), z["i"].alias("i")))


def prefix_number(name: Column, default: int = 999) -> Column:
    """The number before the first dot, or the default: unnumbered names come after 998."""
    return F.coalesce(whole_number(F.regexp_extract(name, r"^(\d+)\.", 1)), F.lit(default).cast("bigint"))


def contiguous_max(pages: DataFrame, number: str, keys: list[str] | None = None) -> DataFrame:
    """keys, last: the last number of the run 0, 1, 2, ... that has no gap, or -1.

    Without a global sort: a number starts a gap where its successor is missing, so the answer is
    the smallest present number whose successor is absent, if 0 is present.
    """
    keys = keys or []
    n = pages.select(*keys, F.col(number).cast("bigint").alias("n")).where("n >= 0").distinct()
    after = n.select(*keys, (F.col("n") - 1).alias("n"))
    ends = n.join(after, [*keys, "n"], "left_anti").groupBy(*keys).agg(F.min("n").alias("end"))
    zero = n.groupBy(*keys).agg(F.min("n").alias("first"))
    both = zero.join(ends, keys) if keys else zero.crossJoin(ends)  # one row each
    return both.select(*keys, F.when(F.col("first") == 0, F.col("end")).otherwise(F.lit(-1)).cast("bigint").alias("last"))


def first_match(files: DataFrame, requested: DataFrame, name: str = "file_name") -> DataFrame:
    """For each requested idx, the first file by name that starts with it, as it is written, and a dot."""
    digits = F.regexp_extract(name, r"^(0|[1-9]\d*)\.", 1)
    numbered = files.select(F.col(name).alias("file_name"), F.nullif(digits, F.lit("")).try_cast("bigint").alias("idx")).where("idx is not null")
    first = numbered.groupBy("idx").agg(F.min("file_name").alias("file_name"))
    return requested.join(first, "idx")


def batches(files: DataFrame, order: list[str], size: int, partition: list[str]) -> DataFrame:
    """files with batch: consecutive groups of at least one row each, in order within the partition."""
    rn = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return files.withColumn("batch", F.floor((rn - 1) / F.lit(max(1, size))).cast("bigint"))
