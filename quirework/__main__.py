"""python -m quirework COMMAND: the steps from page images to a book, over directories.

Where --X takes a path, --X-from takes a file whose first line is that path and goes first.
"""

from __future__ import annotations

import argparse
import importlib
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import layout, merge, order, recognise, split, status
from .sinks.files import export, page_files
from .sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quirework", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str, pointers: tuple[str, ...] = ()):
        c = sub.add_parser(name)
        for x in paths:
            c.add_argument(f"--{x}")
            if x in pointers:
                c.add_argument(f"--{x}-from")
        return c

    c = command("convert")
    c.add_argument("input_pdf"), c.add_argument("output_dir"), c.add_argument("--backend", required=True)
    c.add_argument("--dpi", type=int, default=144), c.add_argument("--start", type=int, default=0), c.add_argument("--format", choices=["jpg", "jpeg", "png"], default="jpg"), c.add_argument("--max-dim", type=int)
    every = ("base-dir", "input-dir", "input-file", "output-dir", "output-file", "prompt-file")
    c = command("ocr", *every, "book-name", pointers=every)
    c.add_argument("--start", type=int), c.add_argument("--end", type=int), c.add_argument("--batch-size", type=int, default=3), c.add_argument("--backend", required=True)
    command("list-fail", "base-dir", "ocr-dir").add_argument("--basename-only", action="store_true")
    paths = ("base-dir", "input-dir", "output-dir", "output-file")
    command("merge-rough", *paths, pointers=paths)
    command("split", "base-dir", "input-file", "output-dir", pointers=("input-file",))
    c = command("typeset", "base-dir", "input-dir", "output-dir", "files-from")
    c.add_argument("--files", nargs="*"), c.add_argument("--file-indices", nargs="*", type=int)
    paths = ("base-dir", "input-dir", "book-name", "output-file")
    command("merge-final", *paths, pointers=paths)
    return p


def backend(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def full(path: str) -> str:
    """A path as it is if it names its store, else from the root."""
    return path if "://" in path else os.path.abspath(path)


def uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Runs one command; gives the paths of list-fail, else []."""
    a = vars(parser().parse_args(argv))
    spark = spark or SparkSession.builder.appName("quirework").getOrCreate()

    def option(name: str, default: str | None = None) -> str | None:
        pointer = a.get(f"{name}_from")
        return (pointer and files.read_pointer(spark, pointer)) or a.get(name) or default

    base = (option("base_dir") or ".").rstrip("/") or "/"
    if a["command"] == "ocr" and option("book_name"):
        base = os.path.join(base, option("book_name"))
    book = option("book_name") or os.path.basename(full(base))
    to = lambda *p: full(os.path.join(base, *p))
    one = lambda df, path: export(df.withColumn("_n", F.lit(os.path.basename(path))), uri(os.path.dirname(full(path))), "_n")
    many = lambda df, path: export(df, uri(path))

    if a["command"] == "convert":
        pdf = spark.read.format("binaryFile").load(a["input_pdf"]).select(F.lit(book).alias("book"), "content")
        pages = recognise.render(pdf, backend(a["backend"]), a["dpi"], a["start"], a["format"], a["max_dim"])
        export(pages.withColumn("file_name", F.concat(F.col("page_no").cast("string"), F.lit("."), "ext")), uri(a["output_dir"]), content="content")
    elif a["command"] == "ocr":
        source, out = option("input_dir", to("images")), option("output_dir", to("ocr-result"))
        images = files.read_images(spark, option("input_file") or source).withColumn("book", F.lit(book))
        if not option("input_file"):
            start, end = a["start"], a["end"]
            if start is None and end is None:
                done = files.list_files(spark, out).where(F.col("file_name").rlike(r"^[0-9]+\.md$")).select(files.page_number(F.col("file_name")).alias("page_no"))
                start, end = status.resume_range(done, images).first()
            images = status.in_range(images, start, end)
        pages = recognise.recognise(images, backend(a["backend"]), files.load_prompt(spark, option("prompt_file")), a["batch_size"])
        pages = pages.persist()
        if option("input_file") and option("output_file"):
            # the marker of a refusal goes beside the others all the same
            one(page_files(pages.where("status = 'ok'")), option("output_file"))
            many(page_files(pages.where("status = 'fail'")), out)
        else:
            many(page_files(pages), out)
        n = {r[0]: r[1] for r in pages.groupBy("status").count().collect()}
        pages.unpersist()
        if total := sum(n.values()):
            done = n.get("ok", 0) + n.get("fail", 0)
            print(spark.range(1).select(status.progress_bar(F.lit(done), F.lit(total))).first()[0])
        if n.get("fail"):
            print(f"failed pages: {n['fail']}")
        bad = sum(n.values()) - n.get("ok", 0) - n.get("fail", 0)
        if bad:
            raise SystemExit(f"{bad} pages have no text")
    elif a["command"] == "list-fail":
        # the book is the directory that holds the results, wherever the base is
        where = full(option("ocr_dir", to("ocr-result"))).rstrip("/")
        root = None if a["basename_only"] else os.path.basename(os.path.dirname(where))
        pages = status.failed_pages(files.list_files(spark, where)).orderBy(order.number_key(F.col("digits")), "digits")
        found = [r[0] for r in pages.select(status.image_path(F.col("digits"), None if a["basename_only"] else "图片", root)).toLocalIterator()]
        print(*found, sep="\n")
        return found
    elif a["command"] == "merge-rough":
        pages = files.read_texts(spark, option("input_dir", to("ocr-result"))).withColumn("book", F.lit(book)).withColumn("key", order.natural_key(F.col("file_name")))
        out = option("output_file") or os.path.join(option("output_dir", to("merge-result")), files.ROUGH)
        one(merge.rough_merge(pages, "book", ["key", "file_name"]), out)
        print(f"merged {pages.count()} files into {out}")
    elif a["command"] == "split":
        path = option("input_file", to("merge-result", files.ROUGH))
        doc = spark.read.format("binaryFile").load(path).select(F.lit(book).alias("book"), F.decode("content", "UTF-8").alias("text"))
        many(split.split_chapters(doc, ["book"]), option("output_dir", to("merge-result")))
    elif a["command"] == "typeset":
        texts = files.read_texts(spark, option("input_dir", to("merge-result"))).withColumn("book", F.lit(book))
        listed = files.read_list(spark, a["files_from"]) if a["files_from"] else None
        asked = files.choose(texts, a["files"], None if listed is None or listed.isEmpty() else listed, a["file_indices"]).distinct()
        for r in asked.join(texts, "file_name", "left_anti").toLocalIterator():
            print(f"not found: {r[0]}")
        many(layout.typeset(texts.join(asked, "file_name", "left_semi"), ["book"]), option("output_dir", to("typeset-result")))
        print(f"files asked for: {asked.count()}")
    else:
        texts = files.numbered(files.read_texts(spark, option("input_dir", to("typeset-result"))).withColumn("book", F.lit(book)))
        one(merge.final_merge(texts, "book", ["number", "file_name"]), option("output_file", to(f"{book}.md")))
    return []


if __name__ == "__main__":
    run()
