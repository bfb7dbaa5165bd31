"""Secret scan: three base patterns, and an assignment-aware lexer over source and configuration.

The lexer goes from target to target (``name =``, ``name: type =``, ``name :=``, ``"name": ``, ``name =>``,
``env["name"] =``, ``call(name, "x")``, ``set_name("x")``, ``export NAME=``, ``name:`` with the value on the
next line or in a block) and lexes what stands there: strings in one, three or back quotes with
prefixes, adjacent or added ones as one literal, also over lines in brackets, or a bare value.  A bare
value that is a name with a literal of its own, given before or else after it, stands for that literal
(constant propagation, over any number of names).  Every literal is scored by its most sensitive target
name and by how random it looks.  Literals that reach the threshold become spans of kind ``lexed``;
base spans always stay.  Comments are read as what they hold.

Names, values and the number of joined literals have no upper bound, and time is linear.

Defined cases: null text counts as empty; a text without matches has counts 0, the digest of the
empty string and spans ''; very long texts are read whole; a literal that several targets score gives
one span; of spans with one start and kind order is by kind, then end; an empty table gives an empty
result; repeated rows give repeated results; extra columns are ignored.  Positions are code points, ends
are exclusive, and a span is what stands inside the quotes.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import sliced, text_or_empty

KINDS = ("assign", "access", "hex", "lexed")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# possessive throughout: no length or count is bounded, and time stays linear
_STRING = re.compile(
    r"""(?:[rRbBuUfF]{1,2}(?=["']))?+(?:\"{3}(?P<a>[^"\\]*+(?:(?:\\.|"(?!""))[^"\\]*+)*+)\"{3}|'{3}(?P<b>[^'\\]*+(?:(?:\\.|'(?!''))[^'\\]*+)*+)'{3}"""
    r"""|"(?P<c>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)"|'(?P<d>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'|`(?P<e>[^`\\\n]*+(?:\\.[^`\\\n]*+)*+)`)""",
    re.S,
)
# a type of over 41 characters is one only before a spaced =, for a bare value can end in one
_TYPE = r"""[A-Za-z_](?:[A-Za-z0-9_\[\]]{0,40}|[A-Za-z0-9_\[\]]*+(?=[ \t]++=(?!=)))"""
#: A name with what makes it a target: an assignment, a call, or a quoted name before another argument.
_TARGET = re.compile(
    rf"""(?P<q>["'`]?)(?<![A-Za-z0-9_.$-])(?P<name>[A-Za-z_$][A-Za-z0-9_.$-]*+)(?P=q)(?:\])?+"""
    rf"""(?:(?:[ \t]*+:[ \t]*+{_TYPE})?[ \t]*+(?P<assign>:=|=>|=(?!=)|:(?!:|//))|(?P<call>\()|[ \t]*+(?P<comma>,))[ \t]*+""",
    re.A,
)
_BARE = re.compile(r"[A-Za-z0-9+/_.=$-]++")
_BETWEEN = re.compile(r"[ \t]*+(?:\+[ \t]*+(?:\n[ \t]*+)?+)?+")
_INDENTED = re.compile(r"(?:[|>][+-]?+[ \t]*+)?+\r?\n[ \t]++(?=[^\s#])")
_ALONE = re.compile(r"[A-Za-z0-9+/_.=$-]++(?=[ \t\r]*+(?:\n|\Z))")
_COMMA = re.compile(r"[ \t]*+,")
_NAME = re.compile(r"\$?[A-Za-z_][A-Za-z0-9_.]*", re.A)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
#: Weight of a word in a target name.
WEIGHTS = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.8, "credentials": 0.8, "private": 0.5, "key": 0.5, "auth": 0.6, "bearer": 0.7, "salt": 0.5, "access": 0.3, "api": 0.4, "session": 0.3, "signing": 0.5, "pass": 0.8}
#: Literals without a digit need more.
THRESHOLD, WORDY, MIN_LITERAL = 1.2, 1.4, 6
#: A name with any weight holds one of these words, so texts without them have no lexed span.
_HINT = re.compile("|".join(w for w in WEIGHTS if not any(v != w and v in w for v in WEIGHTS)), re.I | re.A)
_PLACEHOLDERS = {"changeme", "password", "example", "undefined", "placeholder", "required", "optional", "string", "default"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) of the base patterns, leftmost and non-overlapping by kind.

    Hex and access runs are taken whole, so their length can stand in the pattern; an assignment
    that fails still uses up its characters.
    """
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        out += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def name_weight(name: str) -> float:
    words = [w.lower() for w in _SPLIT.split(name) if w]
    return sum(WEIGHTS.get(w, 0.0) for w in words) + (0.6 if "api" in words and "key" in words else 0.0)


def randomness(literal: str) -> float:
    """0 to 1: bits per character against 4, with character classes and length."""
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, bits / 4) * min(1.0, 0.4 + 0.2 * classes) * min(1.0, 0.5 + n / 32)


def strings_at(text: str, at: int) -> tuple[str, tuple[int, int], int] | None:
    """The literal of the strings that begin here, its span and where they end."""
    wide = text.startswith("(", at)
    if wide:
        at = skip(text, at + 1)
    parts = []
    while m := _STRING.match(text, at):
        parts.append(m.span(m.lastgroup))
        end = m.end()
        at = skip(text, _BETWEEN.match(text, end).end()) if wide else _BETWEEN.match(text, end).end()
    return ("".join(text[a:b] for a, b in parts), (parts[0][0], parts[-1][1]), end) if parts else None


def skip(text: str, at: int) -> int:
    """The next place that is not blank."""
    while at < len(text) and text[at] in " \t\r\n":
        at += 1
    return at


def pairs(text: str):
    """(name, literal, span, whether bare) of all targets, in order; a bare value may be a name itself."""
    at = 0
    while m := _TARGET.search(text, at):
        at, name = m.end(), m["name"].lstrip("$").rstrip(".")
        if m["comma"] and not m["q"] or m["call"] and m["q"]:
            continue
        if found := strings_at(text, at):
            literal, span, end = found
            yield name, literal, span, False
            # the first of several arguments may be the name of the second
            at = at if m["call"] and _COMMA.match(text, end) else end
        elif m["call"]:
            continue
        elif bare := _BARE.match(text, at):
            plain = _NAME.fullmatch(bare[0])
            if plain and text.startswith("(", bare.end()):
                continue  # a called function is no value but a target itself
            if m["assign"] or plain:
                yield name, bare[0], bare.span(), True
                # the next argument may be a target itself
                at = at if m["comma"] else bare.end()
        elif m["assign"] == ":" and (line := _INDENTED.match(text, at)):
            if found := strings_at(text, line.end()):
                yield name, found[0], found[1], False
            elif bare := _ALONE.match(text, line.end()):
                yield name, bare[0], bare.span(), True


def resolved(found: list[tuple]) -> list[tuple[str, str, tuple[int, int], bool]]:
    """The pairs with bare names replaced by the literals they stand for."""
    given: dict[str, list[int]] = {}
    for i, (name, *_) in enumerate(found):
        given.setdefault(name, []).append(i)

    def step(i: int) -> int:
        """The pair that a bare name stands for, or i itself."""
        name, literal, _, bare = found[i]
        if not bare or not _NAME.fullmatch(literal):
            return i
        ref = literal.lstrip("$").rstrip(".")
        at = given.get(ref) or given.get(ref.rsplit(".", 1)[-1])
        if not at:
            return i
        k = bisect_left(at, i)
        return at[k - 1] if k else next((x for x in at[:2] if x != i), i)

    source: dict[int, int] = {}
    for i in range(len(found)):
        # names that only stand for each other end where the way comes back to itself
        path, on = [], set()
        while i not in source and i not in on:
            path.append(i)
            on.add(i)
            i = step(i)
        last = source.get(i, i)
        source.update(dict.fromkeys(path, last))
    return [(name, *found[source[i]][1:]) for i, (name, *_) in enumerate(found)]


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals whose target names, own or through constants, are sensitive enough."""
    if not _HINT.search(text):
        return []
    spans = set()
    for name, literal, span, bare in resolved(list(pairs(text))):
        weight = name_weight(name)
        if not weight or len(literal) < MIN_LITERAL or literal.lower() in _PLACEHOLDERS or span in spans:
            continue
        digits, blank = any(c.isdigit() for c in literal), any(c.isspace() for c in literal)
        if blank and not digits or bare and _NAME.fullmatch(literal) and not digits and weight < 0.8:
            continue
        if weight + randomness(literal) >= (THRESHOLD if digits else WORDY):
            spans.add(span)
    return sorted(spans)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    text = text or ""
    base = base_spans(text)
    join = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)
    every = sorted(base + [(a, b, 3) for a, b in lexed_spans(text)], key=lambda s: (s[0], s[2]))
    n = Counter(k for *_, k in base)
    return n[0], n[1], n[2], hashlib.sha256(join(base).encode()).hexdigest(), join(every)


def _scan(batches):
    for b in sliced(batches):
        rows = [scan_text(t) for t in b.column(1).to_pylist()]
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, list(_OUT)[1:]))], schema=_OUT)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.  No shuffle."""
    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
