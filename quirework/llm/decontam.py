"""Benchmark decontamination by pigeonhole edit matching.

Both sides are lower-cased with runs of blanks as one space.  An item of m characters may differ
in k = m // 20 edits, one at least from 20 characters on; cut into k + 1 pieces, one of them must
then stand unchanged in a document.  An Aho-Corasick automaton finds the pieces in one pass over each
whole text, and Myers' bit-parallel distance verifies the item around each hit.  Items of fewer than
20 characters have no error budget: they are found as they are, between characters that are neither
letters nor digits.

The benchmark goes to executors in blocks of at most BLOCK_CHARS characters, or one item, through the
driver one block at a time; a worker holds one block's automaton and, with several blocks, at most
CHUNK_CHARS characters of documents and one more batch.  Documents are read once and never shuffled
or collected.

Defined cases: null text counts as empty; empty items are found nowhere; repeated items count by
item_id; an item without item_id makes a document contaminated and is listed as null; an empty
benchmark or documents table gives no contamination; very long texts are searched whole; extra columns
are ignored; repeated rows give repeated results.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, sliced, text_or_empty

ERROR_SHARE, BLOCK_CHARS, CHUNK_CHARS = 20, 4_000_000, 16_000_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int) -> int:
    return m // ERROR_SHARE


def cut(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length."""
    n = len(item)
    at = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def myers(pattern_masks: dict[str, int], m: int, text: str, k: int) -> bool:
    """Whether some substring of text is within k edits of the pattern (Myers 1999, Hyyro's form)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for c in text:
        eq = pattern_masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score <= k:
                return True
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return False


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit stands beside text[start:end]."""
    return not (start and text[start - 1].isalnum()) and not text[end : end + 1].isalnum()


def none_last(i: int | None) -> tuple:
    return i is None, i or 0


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = [(i, t, budget(len(t))) for i, t in items if t]
        self.masks = [None] * len(self.items)
        where: dict[str, list[tuple[int, int]]] = {}
        for x, (_, t, k) in enumerate(self.items):
            for off, piece in cut(t, k):
                where.setdefault(piece, []).append((x, off))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[int]:
        """Sorted item ids found in the text."""
        if not self.items:
            return []
        text = normalise(text)
        found: set[int] = set()
        tried: set[tuple[int, int]] = set()
        for end, (size, at) in self.automaton.iter(text):
            for x, off in at:
                if x in found:
                    continue
                _, item, k = self.items[x]
                start = end + 1 - size - off
                if (x, start) in tried:
                    continue
                tried.add((x, start))
                if not k:
                    if alone(text, start, end + 1):
                        found.add(x)
                    continue
                if start >= 0 and text.startswith(item, start):
                    found.add(x)
                    continue
                if self.masks[x] is None:
                    self.masks[x] = masks(item)
                if myers(self.masks[x], len(item), text[max(0, start - k) : start + len(item) + k], k):
                    found.add(x)
        return sorted({self.items[x][0] for x in found}, key=none_last)


def _blocks(benchmark: DataFrame):
    """Lists of (item_id, normalised text), of at most BLOCK_CHARS characters or one item."""
    block, size = [], 0
    for i, t in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        t = normalise(t)
        if block and size + len(t) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, name: str = "_items") -> DataFrame:
    """The rows of docs with one more column: the sorted ids of the items found."""
    sc = docs.sparkSession.sparkContext
    parts = [sc.broadcast(block) for block in _blocks(benchmark)]
    out = docs.withColumn(name, F.array().cast("array<bigint>"))
    return out.mapInArrow(_finder(parts, out.columns.index("text"), out.columns.index(name), CHUNK_CHARS), out.schema)


def _finder(parts: list, at_text: int, at_items: int, chunk: int):
    def told(b, found: list[set]):
        cols = list(b.columns)
        cols[at_items] = pa.array([sorted(f, key=none_last) for f in found], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    def held(batches):
        """Lists of batches with about so many characters in them."""
        some, size = [], 0
        for b in sliced(batches):
            some.append(b)
            size += b.column(at_text).nbytes
            if size > chunk:
                yield some
                some, size = [], 0
        if some:
            yield some

    def run(batches):
        if len(parts) < 2:
            matcher = Matcher(parts[0].value if parts else [])
            for b in sliced(batches):
                yield told(b, [matcher.find(t) for t in b.column(at_text).to_pylist()])
            return
        for some in held(batches):
            found = [[set() for _ in range(b.num_rows)] for b in some]
            for part in parts:
                matcher = Matcher(part.value)
                for b, sets in zip(some, found):
                    for x, t in zip(sets, b.column(at_text).to_pylist()):
                        x.update(matcher.find(t))
            yield from map(told, some, found)

    return run


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, items, contaminated."""
    found = leaks(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.size("_items").cast("long").alias("n_items"), F.col("_items").alias("items"), (F.size("_items") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no item is found, in one pass."""
    name = free_name(docs, "_items")
    return leaks(docs, benchmark, name).where(F.size(name) == 0).drop(name)
