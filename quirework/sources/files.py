"""Files as tables: listings that keep empty files, texts, list files, pointer files and prompts.

Spark's file readers skip empty files, so what is there comes from the store's own listing (any
store that Spark opens) and contents are joined to it.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import newlines, split_lines, strip
from ..operators.order import first_match, prefix_number, whole_number

ROUGH, DEFAULT_PROMPT, PROMPT_FILE = "0.rough.md", "Transcribe all text of this page.", "ocr_prompt.md"
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")
_LISTED = "path string, file_name string, size long"


def _store(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _exists(spark: SparkSession, name: str) -> bool:
    fs, path = _store(spark, name)
    return fs.exists(path) and fs.getFileStatus(path).isFile()


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """path, file_name, size of the files of a directory, empty ones too; a missing directory has none."""
    fs, path = _store(spark, directory)
    rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.isFile()] if fs.exists(path) else []
    return spark.createDataFrame(rows, _LISTED)


def read_texts(spark: SparkSession, directory: str, suffix: str = ".md") -> DataFrame:
    """file_name, text of every file with the suffix; an empty file has the empty text.  Malformed UTF-8 is an error."""
    names = list_files(spark, directory).where(F.col("file_name").endswith(suffix))
    if names.where("size > 0").isEmpty():
        return names.select("file_name", F.lit("").alias("text"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(directory)
    content = content.select(F.element_at(F.split("path", "/"), -1).alias("_n"), F.decode("content", "UTF-8").alias("_t"))
    return names.join(content, F.col("file_name") == F.col("_n"), "left").select("file_name", newlines(F.coalesce("_t", F.lit(""))).alias("text"))


def read_images(spark: SparkSession, directory: str) -> DataFrame:
    """page_no (null if the name is no number), stem, ext, path, content; extensions in any case."""
    glob = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in e) for e in IMAGE_EXTENSIONS) + "}"
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    return files.select(page_number(name).alias("page_no"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), "path", "content")


def page_number(name: Column) -> Column:
    """The number that is a file's whole stem; only 0-9 count as digits."""
    return whole_number(F.regexp_extract(name, r"^([0-9]+)\.[^.]*$", 1))


def first_line(text: str) -> str:
    return next((x.strip() for x in text.splitlines() if x.strip()), "")


def _read(spark: SparkSession, path: str) -> str:
    rows = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8")).take(1)
    return rows[0][0] if rows else ""


def read_pointer(spark: SparkSession, path: str) -> str:
    """The first line of a small file that isn't blank, stripped, else ''."""
    return first_line(_read(spark, path))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """file_name of each line that isn't blank, but for the rough document."""
    lines = spark.read.format("binaryFile").load(path).select(F.explode(split_lines(F.decode("content", "UTF-8"))).alias("line"))
    return lines.select(strip("line").alias("file_name")).where((F.col("file_name") != "") & (F.col("file_name") != ROUGH))


def load_prompt(spark: SparkSession, path: str | None = None) -> str:
    """The text of a prompt file, by default the one in the working directory; a missing or blank one gives the default prompt."""
    path = path or os.path.abspath(PROMPT_FILE)
    return (_read(spark, path).strip() if _exists(spark, path) else "") or DEFAULT_PROMPT


def choose(files: DataFrame, names: list[str] | None = None, listed: DataFrame | None = None, indices: list[int] | None = None) -> DataFrame:
    """file_name of the chapters asked for: a list file first, then indices, then names, else all .md but the rough one."""
    spark = files.sparkSession
    every = files.select("file_name").where(F.col("file_name").endswith(".md") & (F.col("file_name") != ROUGH))
    if listed is not None:
        return listed.select("file_name")
    if indices:
        return first_match(every, spark.createDataFrame([(i,) for i in indices], "idx long")).select("file_name")
    if names:
        return spark.createDataFrame([(n,) for n in names if n != ROUGH], "file_name string")
    return every


def numbered(files: DataFrame) -> DataFrame:
    return files.withColumn("number", prefix_number(F.col("file_name")))
