"""Pages and their recognition: status, failures, what is to be done, retries, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .order import contiguous_max, whole_number

FALLBACK_PAGES, ATTEMPTS = 50, 5


def mime_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(ext == "png", "image/png").when(ext == "webp", "image/webp").when(ext == "bmp", "image/bmp").when(ext.isin("tif", "tiff"), "image/tiff").otherwise("image/jpeg")


def response_text(text: Column, parts: Column) -> Column:
    """The text if it is not empty, else the non-empty parts by line, else ''."""
    joined = strip(F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), "\n"))
    return F.coalesce(F.nullif(text, F.lit("")), joined, F.lit(""))


def is_refusal(reason: Column) -> Column:
    r = F.upper(F.coalesce(reason, F.lit("")))
    return r.contains("PROHIBITED_CONTENT") | r.contains("RECITATION")


def base_url(url: Column) -> Column:
    return F.regexp_replace(url, r"/v1$", "")


def downscaled(w: Column, h: Column, most: int) -> tuple[Column, Column]:
    """Width and height shrunk to fit, never enlarged; fractions are cut."""
    factor = F.least(F.lit(float(most)) / w, F.lit(float(most)) / h)
    small = (w <= most) & (h <= most)
    fit = lambda x: F.when(small, x.cast("int")).otherwise(F.floor(x * factor).cast("int"))
    return fit(w), fit(h)


def dpi_scale(dpi: Column) -> Column:
    return dpi / F.lit(72.0)


def in_range(pages: DataFrame, start: int | None, end: int | None, number: str = "page_no") -> DataFrame:
    """Both bounds or none: with one alone nothing is filtered."""
    return pages if start is None or end is None else pages.where(F.col(number).between(start, end))


def page_status(images: DataFrame, texts: DataFrame, failed: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """keys, status of every image: ok, fail or missing."""
    keys = keys or ["page_no"]
    out = images.select(*keys).join(texts.select(*keys).distinct().withColumn("_ok", F.lit(True)), keys, "left")
    if failed is not None:
        out = out.join(failed.select(*keys).distinct().withColumn("_bad", F.lit(True)), keys, "left")
    else:
        out = out.withColumn("_bad", F.lit(None).cast("boolean"))
    return out.select(*keys, F.when(F.col("_ok"), "ok").when(F.col("_bad"), "fail").otherwise("missing").alias("status"))


def failed_pages(files: DataFrame, name: str = "file_name") -> DataFrame:
    """page_no and digits (as in the name) of every <n>.fail.md."""
    digits = F.regexp_extract(name, r"^(\d+)", 1)
    return files.where(F.col(name).rlike(r"^\d+\.fail\.md$")).select(whole_number(digits).alias("page_no"), digits.alias("digits"))


def image_path(page: Column, directory: str | None = "图片", root: str | None = None) -> Column:
    return F.concat_ws("/", *[F.lit(x) for x in (root, directory) if x], F.concat(page.cast("string"), F.lit(".jpg")))


def resume_range(done: DataFrame, images: DataFrame, number: str = "page_no") -> DataFrame:
    """first, last: from the first gap to the last image, or FALLBACK_PAGES pages."""
    last = contiguous_max(done, number).select(F.col("last").alias("done"))
    last = last.agg(F.coalesce(F.max("done"), F.lit(-1)).alias("done"))
    most = images.agg(F.coalesce(F.max(F.col(number).cast("bigint")), F.lit(-1)).alias("most"))
    x = last.crossJoin(most)  # one row each
    first = F.col("done") + 1
    return x.select(first.alias("first"), F.when(F.col("most") >= first, F.col("most")).otherwise(first + FALLBACK_PAGES - 1).alias("last"))


def pending(images: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Pages without text: unlike resume_range, pages after a gap are not done again."""
    return images.join(texts.select(*keys), keys, "left_anti")


def first_success(attempts: DataFrame, keys: list[str], order: list[str], text: str = "text", reason: str = "finish_reason") -> DataFrame:
    """keys, attempt, text, status of the first of at most ATTEMPTS tries that decides.

    A refusal ends a page as fail, a text that is not empty as ok; else it is exhausted.
    """
    n = attempts.withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("attempt") <= ATTEMPTS)
    verdict = F.when(is_refusal(F.col(reason)), "fail").when(F.coalesce(F.col(text), F.lit("")) != "", "ok")
    n = n.withColumn("_v", verdict)
    best = F.min(F.when(F.col("_v").isNotNull(), F.struct("attempt", F.col("_v").alias("status"), F.when(F.col("_v") == "ok", F.col(text)).alias("text"))))
    return n.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.attempt").alias("attempt"), F.col("b.text").alias("text"), F.coalesce("b.status", F.lit("exhausted")).alias("status"))


def progress(done: Column, total: Column) -> Column:
    """Percent with two digits, null without a total."""
    return F.when(total > 0, F.round(done * 100.0 / total, 2))


def progress_bar(done: Column, total: Column, width: int = 50) -> Column:
    """``[done/total][###---][percent%][RUNNING or OVER]``, null without a total."""
    filled = F.least(F.bround(done * float(width) / total).cast("int"), F.lit(width))
    bar = F.concat(F.repeat(F.lit("#"), filled), F.repeat(F.lit("-"), F.lit(width) - filled))
    state = F.when(done >= total, "OVER").otherwise("RUNNING")
    return F.when(total > 0, F.format_string("[%d/%d][%s][%.2f%%][%s]", done, total, bar, progress(done, total).cast("double"), state))
