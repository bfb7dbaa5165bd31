"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text is normalised to lower-case words, its bigrams are a bag.  For every template the scan finds
the windows of the text with the highest Dice coefficient, 2 * shared / (bigrams of the window + of the
template), of all windows there are.  A coefficient of the threshold needs a number of shared bigrams
and allows a number of bigrams in the window, both set by the template's size; templates and places
whose hits can't reach that are pruned without loss, which leaves few to compare.  A licence may
stand anywhere in a longer text, and a whole text that is a licence is one window.

Defined cases: null text counts as empty; a text without a match has license null, dice 0.0 and
n_matches 0; an empty table gives an empty result; very long texts are scanned whole; of windows that
overlap, the one with the highest coefficient stays, then the larger template, the smaller name, the
earlier place; repeated rows are scanned each; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import sliced, text_or_empty
from .license_texts import TEMPLATES

THRESHOLD = 0.75
_WORDS = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")


def normalise(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


class Scanner:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        listed = sorted((name, tuple(w)) for name, texts in templates.items() for t in texts if len(w := normalise(t)) > 1)
        self.ids: dict[str, int] = {}
        for _, w in listed:
            for x in w:
                self.ids.setdefault(x, len(self.ids) + 1)
        self.width = len(self.ids) + 1
        self.names = [n for n, _ in listed]
        self.bags: list[dict[int, int]] = []
        for _, w in listed:
            bag: dict[int, int] = {}
            for a, b in zip(w, w[1:]):
                g = self.ids[a] * self.width + self.ids[b]
                bag[g] = bag.get(g, 0) + 1
            self.bags.append(bag)
        self.sizes = np.array([sum(b.values()) for b in self.bags])
        # shared bigrams that a match must have, bigrams that its window may have
        self.least = np.ceil(threshold * self.sizes / (2 - threshold) - 1e-9).astype(np.int64)
        self.most = np.floor(self.sizes * (2 - threshold) / threshold + 1e-9).astype(np.int64)
        # a row for each known bigram with a bit for each template, row 0 for all others
        known = sorted(set().union(*self.bags)) if self.bags else []
        self.row = np.zeros(self.width * self.width, np.int32)
        self.row[known] = np.arange(1, len(known) + 1)
        has = np.zeros((len(known) + 1, len(self.bags)), np.uint8)
        for t, bag in enumerate(self.bags):
            has[self.row[list(bag)], t] = 1
        self.has = has

    def windows(self, t: int, at: np.ndarray, grams: np.ndarray):
        """(dice, first, last hit) of the best window from each hit on that reaches the threshold."""
        least, most, size, bag = int(self.least[t]), int(self.most[t]), int(self.sizes[t]), self.bags[t]
        ends = np.searchsorted(at, at + most)  # hits that a window from here on may have
        places = at.tolist()
        codes = grams[at].tolist()
        for i in np.flatnonzero(ends - np.arange(len(at)) >= least).tolist():
            left, shared, best, last = {}, 0, 0.0, i
            start = places[i]
            for j in range(i, ends[i]):
                g = codes[j]
                n = left.get(g, bag[g])
                if not n:
                    continue
                left[g] = n - 1
                shared += 1
                dice = 2 * shared / (places[j] - start + 1 + size)
                if dice > best:
                    best, last = dice, j
            if best >= self.threshold:
                yield best, start, places[last]

    def matches(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, dice, first word, end word) of the best template of each place, in order."""
        words = normalise(text)
        ids = np.fromiter((self.ids.get(w, 0) for w in words), np.int64, len(words))
        if len(ids) < 2 or not self.bags:
            return []
        grams = ids[:-1] * self.width + ids[1:]
        rows = self.row[grams]
        hits = np.flatnonzero(rows)
        if not len(hits):
            return []
        has = self.has[rows[hits]]
        found = []
        for t in np.flatnonzero(has.sum(0, dtype=np.int64) >= self.least).tolist():
            at = hits[has[:, t] > 0]
            found += [(-round(d, 6), -int(self.sizes[t]), self.names[t], a, b + 2) for d, a, b in self.windows(t, at, grams)]
        out: list[tuple[str, float, int, int]] = []
        for d, _, name, a, b in sorted(found):
            if all(b <= x or a >= y for *_, x, y in out):
                out.append((name, -d, a, b))
        return sorted(out, key=lambda m: m[2])


_OUT = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("n_matches", pa.int64()), ("licenses", pa.string())])


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, license, dice, n_matches, licenses.  No shuffle."""

    def run(batches):
        scanner = Scanner(templates, threshold)
        for b in sliced(batches):
            rows = []
            for t in b.column(1).to_pylist():
                m = scanner.matches(t)
                best = max(m, key=lambda x: (x[1], x[3] - x[2], x[0]), default=(None, 0.0))
                rows.append((best[0], best[1], len(m), ",".join(sorted({x[0] for x in m}))))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, list(_OUT)[1:]))], schema=_OUT)

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(run, "doc_id long, license string, dice double, n_matches long, licenses string")
