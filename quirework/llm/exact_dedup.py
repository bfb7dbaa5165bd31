"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text without its blanks is cut where its own characters say so, so equal passages give equal
chunks wherever they stand.  Chunks are reduced to identifiers that are verified (two different
chunks with one hash get different ordinals), and documents are equal when their ordered
identifier lists are equal.  Only distinct chunks are shuffled as text, once; documents move as
short lists of integers.

Defined cases: null text counts as empty; all empty texts form one group; a very long text is a
longer list; of equally long texts the smallest doc_id stays, and a null doc_id only where its
whole group has none; fully repeated rows share one verdict, and :func:`deduplicate` keeps one of
them; an empty table gives an empty result; extra columns are ignored by :func:`verdicts` and
returned by :func:`deduplicate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, keep_one, materialise, text_or_empty

#: Characters that stand for one in 30 to 60 of texts without an alphabet of vowels and consonants: some letters of small scripts, and even shares of large ones.
_MARKS = "\u05d9\u05e8\u0627\u0631\u0930\u0924\u0e19\u0e23\u306e\u3044\u30f3\u30eb" + "".join(
    f"{chr(first)}-{chr(first + size - 1)}" for start, end, step, size in ((0x3400, 0xA000, 0x400, 0x18), (0xAC00, 0xD7A4, 0x400, 0x18), (0x20000, 0x32000, 0x2000, 0xC0)) for first in range(start + 0x40, end, step)
)
#: A chunk ends where such characters meet, after 256 characters at least and 4096 at most.
_LATIN = "[bdgkpvwzäéíóßBDGKPVWZ0-4][aeiouüèñAEIOU][nrstmcNRST5-9]"
_OTHERS = ("[бвгдзклпБВГДЗКЛП][аеиоуАЕИОУ][нрстмНРСТМ]", "[βγδκπθ][αεηιοω][νρστμ]", f"[{_MARKS}]")
CHUNK = rf"(?s).{{256,4096}}?(?:(?<={_LATIN})|(?<=[^\x00-\u036f])(?:{'|'.join(f'(?<={x})' for x in _OTHERS)})|\z)|.{{1,4096}}"


def normalised(c: str | Column = "text") -> Column:
    """The text without any character of [\\x20\\x09-\\x0D]."""
    return F.translate(text_or_empty(c), BLANKS, "")


def chunks(norm: Column, pattern: str = CHUNK) -> Column:
    """Chunks in order; their concatenation is the input, and '' has none."""
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def colliding_chunks(docs: DataFrame, pattern: str = CHUNK, hash_fn=F.xxhash64) -> DataFrame:
    """(h, chunk, ord) of distinct chunks that share a hash with a different chunk."""
    seen = docs.select(F.explode(chunks(normalised("text"), pattern)).alias("chunk")).select(hash_fn("chunk").alias("h"), "chunk").distinct()
    h = seen.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    # nearly always empty, so found from narrow rows first and looked up only if there are any
    found = materialise(h.select("h"), "collided")
    if found.isEmpty():
        return None
    both = seen.join(found, "h").groupBy("h").agg(F.array_sort(F.collect_set("chunk")).alias("all"))
    return materialise(both.select("h", F.posexplode("all").alias("ord", "chunk")), "collisions")


def recipes(docs: DataFrame, pattern: str = CHUNK, hash_fn=F.xxhash64) -> DataFrame:
    """doc_id, n_chars (code points of the original), text_sha256, recipe (array of identifiers)."""
    base = docs.select("doc_id", F.length(text_or_empty("text")).alias("n_chars"), normalised("text").alias("norm"))
    bad = colliding_chunks(docs, pattern, hash_fn)
    plain = base.select(
        "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("norm"), pattern), lambda x: hash_fn(x)).alias("recipe"),
    )
    if bad is None:
        return materialise(plain, "recipes")
    where = (
        base.select(F.sha2("norm", 256).alias("text_sha256"), F.posexplode(chunks(F.col("norm"), pattern)).alias("pos", "chunk"))
        .select("text_sha256", "pos", hash_fn("chunk").alias("h"), "chunk").join(bad, ["h", "chunk"]).where("ord > 0")
        .select("text_sha256", "pos", "ord").distinct()
        .groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("long").alias("pos"), F.col("ord").cast("long").alias("ord")))).alias("fix"))
    )
    # the ordinals follow the hashes, so lists with equal hashes and other chunks differ
    mended = plain.join(where, "text_sha256", "left").select(
        "doc_id", "n_chars", "text_sha256",
        F.when(F.col("fix").isNull(), F.col("recipe")).otherwise(F.concat("recipe", F.flatten(F.transform("fix", lambda x: F.array(x["pos"], x["ord"]))))).alias("recipe"),
    )
    return materialise(mended, "recipes")


def verdicts(docs: DataFrame, pattern: str = CHUNK, hash_fn=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    r = recipes(docs, pattern, hash_fn)
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("neg"))).alias("best")
    groups = r.groupBy("recipe").agg(F.count("*").alias("n"), best).where("n > 1").select("recipe", "n", F.bitwise_not("best.neg").alias("keep"))
    # as a table of its own, so that a hot recipe's rows can be split in the join
    out = r.join(materialise(groups, "groups"), "recipe", "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one of those that repeat.  Documents move once, keyed by doc_id and text hash."""
    return keep_one(docs, verdicts(docs), F.sha2(normalised(docs["text"]), 256), "text_sha256")
