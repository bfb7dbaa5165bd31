"""Text primitives with Python's notion of blanks and line breaks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python strips: Java's own classes miss some of these.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as a class of patterns.
W = r"[\t\n\x0B\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Where Python's splitlines breaks.
LB = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x85\u2028\u2029]"
CJK = r"[\x{4e00}-\x{9fa5}]"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column, blanks: str = BLANKS) -> Column:
    return F.btrim(_c(c), F.lit(blanks))


def rstrip(c: str | Column, blanks: str = BLANKS) -> Column:
    return F.rtrim(_c(c), F.lit(blanks))


def newlines(c: str | Column) -> Column:
    """CR LF and CR as LF, as text-mode reading does."""
    return F.regexp_replace(_c(c), r"\r\n?", "\n")


def split_lines(c: str | Column, breaks: str = LB) -> Column:
    return F.split(_c(c), breaks)


def is_blank(c: str | Column) -> Column:
    return strip(c) == ""


def drop_last_hyphen(c: str | Column) -> Column:
    return F.regexp_replace(_c(c), r"-\z", "")


def ordered_concat(key: list[str], text: str, sep: str) -> Column:
    """Aggregate: texts joined in the order of the key columns."""
    items = F.array_sort(F.collect_list(F.struct(*key, F.col(text).alias("_text"))))
    return F.array_join(F.transform(items, lambda x: x["_text"]), sep)
