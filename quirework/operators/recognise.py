"""External steps as functions that the user gives: page rendering and page recognition.

A backend is any picklable function; it runs on executors in batches.  Concurrency is the number
of partitions that run at a time, so ``partitions`` stands for the size of a batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .status import ATTEMPTS

#: Seconds between attempts.
PAUSE = 2.0
REFUSALS = ("PROHIBITED_CONTENT", "RECITATION")


def _field(x, name: str):
    """A key of a mapping or an attribute of any other object, None where there is none."""
    return x.get(name) if isinstance(x, dict) else getattr(x, name, None)


def _candidate(answer):
    """The first of an answer's candidates, if it has any."""
    found = _field(answer, "candidates")
    return found[0] if isinstance(found, (list, tuple)) and found else None


def answer_text(answer) -> str:
    """The text of an answer, else its non-empty parts by line; both also as those of its first candidate."""
    if text := _field(answer, "text"):
        return text
    parts = _field(answer, "parts") or _field(_field(_candidate(answer), "content"), "parts") or ()
    texts = (p if isinstance(p, str) or p is None else _field(p, "text") for p in parts)
    return "\n".join(t for t in texts if t).strip()


def finish_reason(answer) -> str:
    """Why an answer ended, in either spelling: its own, its first candidate's, or the same of its dump; else ''."""

    def told(x) -> str:
        for view in (x, _candidate(x)):
            for name in ("finish_reason", "finishReason"):
                if value := _field(view, name):
                    return str(value)
        return ""

    if reason := told(answer):
        return reason
    for method in ("model_dump", "to_dict"):
        if callable(dump := getattr(answer, method, None)):
            try:
                return told(dump() or {})
            except Exception:  # noqa: BLE001  an answer that can't be dumped has no reason
                continue
    return ""


def attempt(call: Callable[[], object], attempts: int = ATTEMPTS, pause: float = PAUSE) -> tuple[str | None, str, int]:
    """(text, status, tries): ok, fail for a refusal at once, error after the last try without a text."""
    for n in range(1, attempts + 1):
        try:
            answer = call()
        except Exception as e:  # noqa: BLE001  a backend may raise anything; the last one is reported in the row
            why = f"error: {type(e).__name__}"
        else:
            if any(r in finish_reason(answer).upper() for r in REFUSALS):
                return None, "fail", n
            if text := answer_text(answer):
                return text, "ok", n
            why = "error: empty"
        if n < attempts:
            time.sleep(pause)
    return None, why, attempts


def recognise(images: DataFrame, backend: Callable[[bytes, str, str], dict], prompt: str, partitions: int = 3, attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """book, stem, page_no, text, status, tries of images (book, page_no or stem or both, ext, content).

    A page is its file's stem, which need be no number.  Of two images of a page the first extension
    counts.  backend(content, extension, prompt) gives a dict or an object with text, parts and
    finish_reason, or with such candidates.
    """
    if "stem" not in images.columns:
        images = images.withColumn("stem", F.col("page_no").cast("string"))
    if "page_no" not in images.columns:
        images = images.withColumn("page_no", F.col("stem").try_cast("bigint"))
    first = images.groupBy("book", "stem").agg(F.min(F.struct("ext", "content", "page_no")).alias("i")).select("book", "stem", "i.page_no", "i.ext", "i.content")

    def run(frames):
        for f in frames:
            found = [attempt(lambda c=c, e=e: backend(bytes(c), e, prompt), attempts, pause) for c, e in zip(f["content"], f["ext"])]
            yield f[["book", "stem"]].assign(page_no=f["page_no"].astype("Int64"), text=[x[0] for x in found], status=[x[1] for x in found], tries=[x[2] for x in found])

    return first.repartition(max(1, partitions), "book", "stem").mapInPandas(run, "book string, stem string, page_no long, text string, status string, tries int")


def render(documents: DataFrame, renderer: Callable[[bytes, float, str, int | None], Iterable[bytes]], dpi: int = 144, start: int = 0, ext: str = "jpg", most: int | None = None) -> DataFrame:
    """book, page_no, ext, content of each page of documents (book, content); pages count from start.

    renderer(content, scale, extension, largest side) gives the pages' images in order.
    """
    scale = dpi / 72

    def run(frames):
        import pandas as pd

        for f in frames:
            for book, content in zip(f["book"], f["content"]):
                for i, image in enumerate(renderer(bytes(content), scale, ext, most)):
                    yield pd.DataFrame({"book": [book], "page_no": [start + i], "ext": [ext], "content": [image]})

    return documents.select("book", "content").mapInPandas(run, "book string, page_no long, ext string, content binary")
