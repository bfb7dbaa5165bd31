"""Artefact cleanup, in order: repeated CJK words, runs of a CJK character, notes over several lines.

Repeated Latin words are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import CJK, LB, W


def word_repeats(c: Column) -> Column:
    return F.regexp_replace(c, rf"({CJK}{{2,}})\1+", "$1")


def character_runs(c: Column) -> Column:
    return F.regexp_replace(c, rf"({CJK})\1{{2,}}", "$1$1")


def flatten_notes(c: Column) -> Column:
    """Lines inside each shortest <sup>...</sup> are stripped and joined without a separator."""
    inner = f"{W}*(?:{LB}){W}*"

    def flat(seg: Column) -> Column:
        at = F.instr(seg, "<sup>")
        head, note = F.substr(seg, F.lit(1), at + 4), F.substr(seg, at + 5, F.length(seg))
        return F.when(seg.endswith("</sup>") & (at > 0), F.concat(head, F.regexp_replace(F.regexp_replace(note, inner, ""), f"^{W}*(?:{LB})", ""))).otherwise(seg)

    return F.array_join(F.transform(F.split(c, "(?<=</sup>)"), flat), "")


def clean(c: Column) -> Column:
    return flatten_notes(character_runs(word_repeats(c)))
