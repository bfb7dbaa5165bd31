"""Texts and images written as one file each, by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export(files: DataFrame, directory: str, name: str = "file_name", content: str = "text") -> None:
    """One file per row under a directory all executors share; nothing is swallowed, a retried task writes the same again."""
    rows = files.select(F.col(name).alias("n"), F.col(content).cast("binary").alias("c"))

    def write(part):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(directory)
        store.create_dir(root)
        for r in part:
            with store.open_output_stream(f"{root}/{r.n}") as out:
                out.write(bytes(r.c or b""))

    rows.foreachPartition(write)


def page_files(pages: DataFrame) -> DataFrame:
    """file_name, text of recognised pages: <stem>.md, and an empty <stem>.fail.md for refusals."""
    failed = F.col("status") == "fail"
    return pages.where(F.col("status").isin("ok", "fail")).select(
        F.concat("stem", F.when(failed, ".fail.md").otherwise(".md")).alias("file_name"), F.when(failed, "").otherwise(F.col("text")).alias("text")
    )
