"""Best-fit-decreasing packing of tokenised documents.

Lengths are whole numbers up to the capacity, so bins with equal room are alike: the exact
best-fit-decreasing packing of the whole corpus follows from the histogram of piece lengths, at
most ``capacity`` numbers however large the corpus is.  A segment tree over remaining capacities
finds the tightest open bins in logarithmic time; bins are held as runs, so the packing of 1e10
pieces costs as much as that of 1e4.  Each piece then finds its place by its rank among pieces of
its length, which is counted in salted buckets.

Defined cases: null text counts as empty and gives the end token alone; repeated rows are packed
each for itself; a very long text is cut into pieces of the capacity, the first one shorter; pieces
of one length are dealt by (doc_id, piece, ids_crc32), and which of fully repeated ones goes where
doesn't matter; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import base64
import json
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise, sliced, text_or_empty

CAPACITY, END_ID = 1024, 2


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_ENCODERS: dict = {}


def encoder(path: str):
    """A byte-level BPE encoder, one per worker process.

    The ranks file holds the vocabulary of the tokenizers file of the same name, whose added tokens
    are the encoder's special tokens; tests compare ids.
    """
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
            added = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(s, capacity) for s in range(first, n, capacity)]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, added_tokens: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and the end id.

    The vocabulary's added tokens are read in texts, as tokenizers does; without added_tokens they are text.
    """
    path = vocabulary or default_vocabulary()

    def run(batches):
        enc = encoder(path)
        special = "all" if added_tokens else set()
        for b in sliced(batches):
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = array.array("I", enc.encode(t or "", allowed_special=special, disallowed_special=()))
                raw.append(end_id)
                mem = memoryview(raw.tobytes())
                rows += [(d, k, s, n, zlib.crc32(mem[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(raw), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _PIECES)], schema=_PIECES)

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Rooms:
    """Segment tree over remaining capacities that says which have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.size)

    def set(self, r: int, some: bool) -> None:
        i = r + self.size
        self.some[i] = some
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that some open bin has."""
        i = least + self.size
        if self.some[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Placements (length, rank0, n, per_bin, sequence0, offset0) and the number of sequences.

    Pieces of ``length`` with ranks rank0..rank0+n-1 go per_bin to a sequence from sequence0 on.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}
    rooms, out, made = Rooms(capacity), [], 0

    def add(room: int, first: int, count: int) -> None:
        if count and room:
            open_bins.setdefault(room, []).append((first, count))
            rooms.set(room, True)

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first, count = capacity, made, -(-left // (capacity // length))
                made += count
            else:
                first, count = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.set(room, False)
            per = room // length
            n = min(left, per * count)
            full, some = divmod(n, per)
            if full:
                out.append((length, rank, full * per, per, first, capacity - room))
                add(room - per * length, first, full)
            if some:
                out.append((length, rank + full * per, some, per, first + full, capacity - room))
                add(room - some * length, first + full, 1)
            used = full + bool(some)
            add(room, first + used, count - used)
            left, rank = left - n, rank + n
    return out, made


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, added_tokens: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    p = materialise(pieces(docs, capacity, end_id, vocabulary, added_tokens), "pieces")
    buckets = 4 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    p = p.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = p.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    counts = materialise(counts.select("length", "bucket", "n", before.alias("before")), "counts")
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placed, _ = best_fit(histogram, capacity)
    table = spark.createDataFrame(placed or [(0, 0, 0, 1, 0, 0)], "l long, rank0 long, n long, per long, seq0 long, off0 long")
    ranked = p.withColumn("rn", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    # counts grow with the buckets, so they are never broadcast; ranked has its partitioning already
    ranked = ranked.join(counts.drop("n").hint("merge"), ["length", "bucket"]).withColumn("rank", F.col("rn") + F.col("before"))
    step = F.col("rank") - F.col("rank0")
    hit = (F.col("length") == F.col("l")) & (step >= 0) & (step < F.col("n"))
    table = F.broadcast(table) if len(placed) <= BROADCAST_ROWS else table
    return ranked.join(table, hit).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("seq0") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("off0") + (step % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )
