"""Merging pages into a rough document and chapters into a book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LB, W, is_blank, newlines, ordered_concat, split_lines, strip

_HEADING = f"^{W}*#{{1,6}}{W}+(.+?){W}*$"


def join_pages(pages: DataFrame, book: str, order: list[str], text: str = "text") -> DataFrame:
    """book, text: stripped pages that are not empty, in order, a blank line between."""
    p = pages.select(book, *order, strip(newlines(text)).alias("_t")).where("_t <> ''")
    return p.groupBy(book).agg(ordered_concat(order, "_t", "\n\n").alias("text"))


def to_lines(docs: DataFrame, key: list[str], text: str = "text", breaks: str = LB) -> DataFrame:
    return docs.select(*key, F.posexplode(split_lines(text, breaks)).alias("line_no", "line"))


def heading_title(line: Column) -> Column:
    """The title of a heading of any level, else ''."""
    return F.regexp_extract(line, _HEADING, 1)


def dedupe_headings(lines: DataFrame, key: list[str], pos: str = "line_no") -> DataFrame:
    """Later headings with an equal title become blank lines; the first stays.

    First positions are aggregated before they meet the lines, so a title on every page is no
    single task's work.
    """
    t = lines.withColumn("title", strip(heading_title(F.col("line"))))
    first = t.where("title <> ''").groupBy(*key, "title").agg(F.min(pos).alias("_first"))
    out = t.join(first, [*key, "title"], "left")
    return out.withColumn("line", F.when(F.col(pos) > F.col("_first"), F.lit("")).otherwise(F.col("line"))).drop("_first", "title")


def collapse_blanks(lines: DataFrame, key: list[str], pos: str = "line_no") -> DataFrame:
    """Blank lines as '', runs of them as one."""
    w = Window.partitionBy(*key).orderBy(pos)
    x = lines.withColumn("line", F.when(is_blank("line"), F.lit("")).otherwise(F.col("line")))
    return x.withColumn("_b", F.lag("line").over(w)).where("not (line = '' and coalesce(_b, 'x') = '')").drop("_b")


def page_lines(pages: DataFrame, book: str, order: list[str], text: str = "text") -> DataFrame:
    """book, at (page rank and line), line: stripped pages that are not empty, and a blank line after each."""
    p = pages.select(book, *order, strip(newlines(text)).alias("_t")).where("_t <> ''")
    p = p.select(book, F.row_number().over(Window.partitionBy(book).orderBy(*order)).alias("_p"), F.concat("_t", F.lit("\n")).alias("_t"))
    return p.select(book, "_p", F.posexplode(split_lines("_t")).alias("_l", "line")).select(book, F.struct("_p", "_l").alias("at"), "line")


def rough_merge(pages: DataFrame, book: str, order: list[str], text: str = "text") -> DataFrame:
    """book, text: pages joined, headings deduplicated over the book, blanks collapsed; one string only at the end."""
    lines = page_lines(pages, book, order, text)
    lines = collapse_blanks(dedupe_headings(lines, [book], "at"), [book], "at")
    return lines.groupBy(book).agg(F.concat(strip(ordered_concat(["at"], "line", "\n")), F.lit("\n")).alias("text"))


def final_merge(chapters: DataFrame, book: str, order: list[str], text: str = "text") -> DataFrame:
    """book, text: stripped chapters in order, empty ones too, and a newline at the end."""
    c = chapters.select(book, *order, strip(newlines(text)).alias("_t"))
    return c.groupBy(book).agg(F.concat(ordered_concat(order, "_t", "\n\n"), F.lit("\n")).alias("text"))
