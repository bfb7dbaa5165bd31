"""Splitting a document into chapters at first-level headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import W, newlines, strip


def safe_title(c: Column) -> Column:
    return F.regexp_replace(c, r'[\\/*?:"<>|]', "_")


def override_levels(lines: DataFrame, levels: DataFrame, key: list[str]) -> DataFrame:
    """Sets heading levels by (key, title, level): the manual step between merge and split, as a table."""
    from .merge import heading_title

    t = lines.withColumn("title", strip(heading_title(F.col("line"))))
    out = t.join(levels, [*key, "title"], "left")
    return out.withColumn("line", F.when(F.col("level").isNotNull(), F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.col("title"))).otherwise(F.col("line"))).drop("level", "title")


def split_chapters(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key, idx (from 1), title, safe_title, file_name, text; what stands before the first heading is lost."""
    parts = F.split(newlines(text), f"(?md)^#{W}+")
    p = docs.select(*key, F.posexplode(parts).alias("idx", "part")).where("idx >= 1")
    title = strip(F.substring_index("part", "\n", 1))
    body = F.when(F.instr("part", "\n") > 0, F.substr("part", F.instr("part", "\n") + 1)).otherwise(F.lit(""))
    p = p.select(*key, F.col("idx").cast("int").alias("idx"), title.alias("title"), body.alias("body"))
    safe = safe_title(F.col("title"))
    return p.select(*key, "idx", "title", safe.alias("safe_title"), F.concat(F.col("idx").cast("string"), F.lit("."), safe, F.lit(".md")).alias("file_name"), F.concat(F.lit("# "), "title", F.lit("\n"), "body").alias("text"))
