"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel with Nystroem landmarks.

Words are folded (case, look-alike digits and signs, marks inside a word; single letters in a row
are joined, also as a whole; text without blanks gives a form for each of its characters), so
``S-t.u p1d`` style spellings meet their landmark.  The kernel of two strings counts common
subsequences of up to three characters, each weighted by DECAY to the power of the span it covers
in both, so gaps and inserted characters cost something but not everything; it is normalised to
0..1.  The value of a word with a landmark is the largest kernel of the landmark with a window of
the word, at its start or inside of it.

Landmarks are beginnings of words that labelled toxic texts have significantly more often than
others; they may be in others too.  Values count from a floor on, which each landmark has by what
the training texts show: the lowest at which words between it and 1 still tell toxic texts.  A
document is, for each landmark, its largest value and its values' share of all words, both mapped by
the inverse root of the landmarks' own kernel matrix (Nystroem), scored by a linear SVM, and turned
into a probability by a logistic curve fitted on the training margins.  No input but the text is used.

Training takes at most SAMPLE labelled documents of each class, by hash order, and never one
whose crc32(doc_id as text) mod 5 is 0.  Everything else reads every row and whole text.  The model
is fitted in one executor task from the sample's words, and the driver gets the model alone.

Defined cases: null and empty texts get the score of a text without any landmark; very long texts
are read whole; without both classes in the training rows the score is the share of toxic ones (0
without rows); an empty table gives an empty result; repeated rows are scored alike, and a doc_id
with several texts trains with the smallest; extra columns are ignored or kept as they are.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, sliced, text_or_empty, tidy

SAMPLE, LANDMARKS = 1500, 64
DECAY, ORDER, SHARP = 0.7, 3, 2
RIDGE = 0.05
#: A landmark is in so many toxic training texts at least, has so many letters, and tells them with this much likelihood ratio (twice its log).
MIN_SUPPORT, MIN_LETTERS, LONGEST, MIN_TELLING, MIN_RATIO = 3, 3, 24, 20.0, 3.0
#: Values count from one of these on, and a share of words that counts half.
FLOORS, HALF = (0.4, 0.55, 0.7, 0.85, 0.99), 0.01
#: A window has at most so many characters more than its landmark.
SLACK = 3
#: So many words are remembered by a worker.
MEMORY = 150_000  # twice, the words met of late and those before

_LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_LATIN = frozenset("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))) - {"\xf7"}
_ENDS = ".,;:!?\"'()[]"
_INNER = re.compile(r"[^\w@$]+|_+")
_SINGLES = re.compile(r"(?<!\S)\S(?:[ \t]+\S){2,}(?!\S)")
#: Scripts that put no blanks between words.
_SOLID = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿]{2,}")
OPEN, CLOSE = "{", "|"
_FACTORS = np.random.default_rng(7).integers(1, 2**63, LONGEST + SLACK + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fold(word: str) -> str:
    """Lower-case letters of a word in any script, marks and accents beyond Latin-1 gone, look-alikes resolved."""
    w = word.lower().strip(_ENDS)
    if not w.isascii() or not w.isalpha():
        w = w.translate(_LOOKS)
        if not all(c in _LATIN for c in w):
            w = "".join(x for c in w for x in (c if c in _LATIN else unicodedata.normalize("NFKD", c)) if x in _LATIN or (x > "\xff" and x.isalpha()))
    return w


def forms(token: str) -> set[str]:
    """The folded forms of a token: as a whole, what stands between its marks, and places in unspaced scripts."""
    plain = token.strip(_ENDS)
    if plain.isalpha() and plain.islower() and (plain.isascii() or _LATIN.issuperset(plain)):
        return {plain}
    out = {fold(x) for x in ({token} if token.isalnum() else {token, *_INNER.split(token)})}
    if not token.isascii():
        out |= {m[0][i : i + 8] for x in list(out) for m in _SOLID.finditer(x) for i in range(len(m[0]))}
    return out - {""}


def tokens(text: str | None) -> Counter:
    """How often each raw word, in lower case, is in a text; single characters in a row make one more word."""
    text = (text or "").lower()
    out = Counter(text.split())
    for m in _SINGLES.finditer(text):
        out["".join(m[0].split())] += 1
    return out


def codes(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings after one another, and where each begins, with the end."""
    raw = np.frombuffer("".join(items).encode("utf-32-le", "surrogatepass"), np.uint32)
    return raw, np.concatenate(([0], np.cumsum(np.fromiter(map(len, items), np.int64, len(items)))))


def _table(items: list[str], width: int) -> np.ndarray:
    """Code points in rows, 0 beyond the end."""
    raw, at = codes(items)
    place = np.arange(width)
    inside = place < np.diff(at)[:, None]
    return np.where(inside, np.append(raw, 0)[np.minimum(at[:-1, None] + place, len(raw))], 0).astype(np.uint32)


def _powers(n: int) -> np.ndarray:
    """DECAY to the power of column less row, 0 below."""
    step = np.arange(n)[None, :] - np.arange(n)[:, None]
    return np.where(step >= 0, DECAY ** np.maximum(step, 0), 0).astype(np.float32)


def kernel_parts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For row pairs, what each pair of last characters adds to the gap-weighted subsequence kernel (Lodhi et al. 2002).

    Sums over lengths 1 to ORDER; length 1 counts little.  Zeros match nothing.  A sum over the first
    i and j characters is the kernel of the two beginnings.
    """
    hit = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] > 0)).astype(np.float32) * np.float32(DECAY * DECAY)
    match, out = hit, hit * np.float32(0.25)
    left, right = _powers(a.shape[1]).T, _powers(b.shape[1])
    for order in range(2, ORDER + 1):
        before = np.zeros_like(hit)
        before[:, 1:, 1:] = (left @ hit @ right)[:, :-1, :-1]
        hit = match * before
        out += hit * np.float32(4.0 ** (order - 2))
    return out


def normalised_kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel values of row pairs, 0 to 1, raised to SHARP (a product of kernels is a kernel)."""
    ta, tb = _table(a, max(map(len, a))), _table(b, max(map(len, b)))
    k = lambda x, y: kernel_parts(x, y).sum((1, 2))
    return (k(ta, tb) / np.sqrt(k(ta, ta) * k(tb, tb))) ** SHARP


def window_values(windows: np.ndarray, landmark: str) -> np.ndarray:
    """For rows of characters, the largest normalised kernel of one of their beginnings with the landmark."""
    b = _table([landmark], len(landmark))
    own = float(kernel_parts(b, b).sum())
    out = np.zeros(len(windows), np.float32)
    least = max(1, len(landmark) - 2)
    for at in range(0, len(windows), 4096):
        a = windows[at : at + 4096]
        with_it = kernel_parts(a, np.broadcast_to(b, (len(a), b.shape[1]))).sum(2).cumsum(1)
        alone = np.einsum("nii->ni", kernel_parts(a, a).cumsum(1).cumsum(2))
        k = (with_it / np.sqrt(np.maximum(alone, 1e-12) * own)) ** SHARP
        out[at : at + 4096] = k[:, least - 1 :].max(1)
    return out


class Kernel:
    """Values of words with fixed landmarks.

    A window is looked at if it has all but one of the landmark's distinct letters; that bounds the work, and
    tests compare it with all windows.
    """

    def __init__(self, landmarks: list[str], floors: list[float] | None = None, inside: list[bool] | None = None, harmless: set[str] = frozenset()):
        n = len(landmarks)
        self.landmarks, self.harmless = landmarks, harmless
        self.floors = np.array(floors if floors is not None else [FLOORS[0]] * n, np.float32)
        self.inside = inside if inside is not None else [True] * n
        bit = lambda c: 1 << (ord(c) & 63)
        self.letters = [np.uint64(sum({bit(c) for c in {*x} - {OPEN, CLOSE}})) for x in landmarks]

    def values(self, items: list[str], start: bool = True, inner: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, values) of the folded words that have any value."""
        n = len(self.landmarks)
        if not items:
            return np.zeros(0, np.int64), np.zeros((0, n), np.float32)
        raw, at = codes([OPEN + x + CLOSE for x in items])
        bits = np.uint64(1) << (raw & np.uint32(63)).astype(np.uint64)
        has = np.bitwise_or.reduceat(bits, at[:-1])
        raw = np.append(raw, np.zeros(LONGEST + SLACK + 2, np.uint32))
        hits = []
        for x, landmark in enumerate(self.landmarks):
            few = lambda lack: (lack & (lack - (lack > 0).astype(np.uint64))) == 0
            near = np.flatnonzero(few(self.letters[x] & ~has))
            if not len(near):
                continue
            width = len(landmark) + SLACK
            where, rows = [], []
            if start:
                where.append(at[near]), rows.append(near)
            if inner and self.inside[x]:
                sizes = np.maximum(at[near + 1] - at[near] - 3, 0)  # beginnings after the first letter, before the end mark
                r = np.repeat(near, sizes)
                p = np.arange(len(r)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + at[r] + 2
                if self.harmless:
                    known = np.array([items[i] in self.harmless for i in near])
                    p, r = (v[~np.repeat(known, sizes)] for v in (p, r))
                where.append(p), rows.append(r)
            if not where:
                continue
            p, r = np.concatenate(where), np.concatenate(rows)
            place = p[:, None] + np.arange(width)
            windows = np.where(place < at[r + 1][:, None], raw[place], 0)
            if len(windows):
                full = few(self.letters[x] & ~np.bitwise_or.reduce(np.where(windows > 0, np.uint64(1) << (windows & 63).astype(np.uint64), np.uint64(0)), axis=1))
                windows, r = windows[full], r[full]
            if not len(windows):
                continue
            # equal windows once, told apart by a 64-bit hash
            _, one, back = np.unique((windows * _FACTORS[:width]).sum(1), return_index=True, return_inverse=True)
            v = window_values(windows[one], landmark)[back]
            some = v >= self.floors[x]
            hits.append((x, r[some], v[some]))
        rows = np.unique(np.concatenate([r for _, r, _ in hits])) if hits else np.zeros(0, np.int64)
        out = np.zeros((len(rows), n), np.float32)
        for x, r, v in hits:
            np.maximum.at(out[:, x], np.searchsorted(rows, r), v)
        return rows, out


def unlike(docs: list[tuple], names: list[str]) -> list[tuple]:
    """One of the documents whose rare words have the same minimum hash, as those of near copies mostly do.

    Else what copies of one toxic text share would look like an insult.
    """
    n = np.zeros(len(names), np.int64)
    for at, _ in docs:
        n[at] += 1
    rare = n <= len(docs) * 0.03 + 1
    crc = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in names], np.int64)
    return list({int(crc[at][rare[at]].min(initial=2**32 + i)): (at, c) for i, (at, c) in enumerate(docs)}.values())


def telling(a, b, na: int, nb: int):
    """Twice the log of the likelihood ratio of counts a of na against b of nb, 0 where b is the more frequent."""
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    ea, eb = (a + b) * na / (na + nb), (a + b) * nb / (na + nb)
    g = 2 * (a * np.log(np.maximum(a, 1e-9) / np.maximum(ea, 1e-9)) + np.where(b > 0, b * np.log(np.maximum(b, 1e-9) / np.maximum(eb, 1e-9)), 0))
    return np.where(a * nb > b * na, g, 0.0)


def find_landmarks(toxic: list[tuple], other: list[tuple], vocabulary: list[str]) -> list[str]:
    """Beginnings of words that tell toxic texts, the most telling first.

    Words that one explains no longer speak for another.  Documents are numbers of words in vocabulary, and counts.
    """
    na, nb = len(toxic), len(other)
    totals = []
    for docs in (toxic, other):
        total = np.zeros(len(vocabulary), np.int64)
        for at, c in docs:
            total[at] += np.minimum(c, 3)
        totals.append({vocabulary[i]: int(total[i]) for i in np.flatnonzero(total)})
    inside, outside = totals
    number = {w: i for i, w in enumerate(vocabulary)}
    marked = {w: OPEN + w + CLOSE for w in inside}

    def least(w: str) -> int:
        return 3 if _SOLID.match(w) else MIN_LETTERS + 1

    def beginnings(w: str):
        m = OPEN + w + CLOSE
        return (m[:k] for k in range(least(w), min(len(m), 10) + 1))

    a: Counter = Counter()
    for w, c in inside.items():
        for g in beginnings(w):
            a[g] += c
    a = Counter({g: c for g, c in a.items() if c >= MIN_SUPPORT})
    b = Counter(dict.fromkeys(a, 0))
    for w, c in outside.items():
        for g in beginnings(w):
            if g in b:
                b[g] += c
    told = np.array([a[g] for g in a]), np.array([b[g] for g in a])
    if not a:
        return []
    worth = telling(*told, na, nb)
    names = [g for g, ok in zip(a, (worth >= MIN_TELLING) & (told[0] * nb >= MIN_RATIO * told[1] * na)) if ok]
    by_start: dict[str, list[str]] = {}
    for w in inside:
        by_start.setdefault(marked[w][:3], []).append(w)
    found: list[str] = []
    gone: set[str] = set()
    while names and len(found) < LANDMARKS:
        scores = {}
        for g in names:
            scores[g] = float(telling(a[g], b[g], na, nb)) if a[g] >= MIN_SUPPORT and a[g] * nb >= MIN_RATIO * b[g] * na else 0.0
        g = max(scores, key=lambda g: (scores[g], len(g), g))
        if scores[g] < MIN_TELLING:
            break
        names = [x for x in names if scores[x] >= MIN_TELLING and x != g]
        words = [w for w in by_start[g[:3]] if marked[w].startswith(g) and w not in gone]
        mine = np.zeros(len(vocabulary), bool)
        mine[[number[w] for w in words]] = True
        if sum(bool(mine[at].any()) for at, _ in toxic) < MIN_SUPPORT:
            continue
        # as much of it as nearly all of these words share
        long = g
        while len(long) < LONGEST:
            nexts = Counter()
            for w in words:
                if marked[w].startswith(long):
                    nexts[marked[w][len(long) : len(long) + 1]] += inside[w]
            x, c = nexts.most_common(1)[0]
            if not x or c < 0.9 * nexts.total():
                break
            long += x
        found.append(long)
        gone.update(words)
        for w in words:
            for x in beginnings(w):
                a[x] -= inside[w]
        for w, c in outside.items():
            if (OPEN + w + CLOSE).startswith(g):
                for x in beginnings(w):
                    if x in b:
                        b[x] -= c
    return found


class Model:
    """Landmarks with their floors, their Nystroem map, the SVM's weights and the logistic curve."""

    def __init__(self, share: float = 0.0):
        self.share, self.landmarks = share, []

    def fit(self, texts: list[str], labels: list[int]) -> Model:
        return self.fit_tokens((tokens(t) for t in texts), labels)

    def fit_tokens(self, docs, labels: list[int]) -> Model:
        """docs: the counters of the texts' raw words, one at a time; they are held as numbers."""
        y = np.array(labels)
        self.share = float(y.mean()) if len(y) else 0.0
        if len(set(labels)) < 2:
            return self
        of_word: dict[str, int] = {}
        raw = []
        for d in docs:
            at = np.fromiter((of_word.setdefault(w, len(of_word)) for w in d), np.int32, len(d))
            raw.append((at, np.fromiter(d.values(), np.int32, len(d))))
        of_form: dict[str, int] = {}
        first, flat = [0], []
        for w in of_word:
            flat += [of_form.setdefault(f, len(of_form)) for f in sorted(forms(w))]
            first.append(len(flat))
        vocabulary, n_words = list(of_form), len(of_word)
        del of_word, of_form
        first, flat = np.array(first), np.array(flat, np.int32)
        folded = []
        for at, c in raw:
            sizes = first[at + 1] - first[at]
            place = np.repeat(first[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            f, back = np.unique(flat[place], return_inverse=True)
            folded.append((f, np.bincount(back, np.repeat(c, sizes), len(f)).astype(np.int64)))
        toxic, other = [d for d, t in zip(folded, y) if t], [d for d, t in zip(folded, y) if not t]
        self.landmarks = find_landmarks(unlike(toxic, vocabulary), other, vocabulary)
        if not self.landmarks:
            return self
        n = len(self.landmarks)
        # in how many texts of each class each word is, then what each value is worth
        df = np.zeros((2, len(vocabulary)))
        for (f, _), t in zip(folded, y):
            df[int(t), f] += 1
        plain = Kernel(self.landmarks)
        na, nb = len(toxic), len(other)
        del folded, toxic, other

        def floors(rows: np.ndarray, v: np.ndarray) -> list[float]:
            out = []
            for x in range(n):
                best = 2.0
                for low, high in zip(FLOORS[::-1], (2.0, *FLOORS[:0:-1])):
                    at = rows[(v[:, x] >= low) & (v[:, x] < high)]
                    a, b = df[1, at].sum(), df[0, at].sum()
                    if b > 0.002 * nb and a * nb < MIN_RATIO * b * na:
                        break
                    best = low
                out.append(best)
            return out

        rows, v = plain.values(vocabulary, inner=False)
        starts = floors(rows, v)
        rows, v = plain.values(vocabulary, start=False)
        within = floors(rows, v)
        # inside of words a landmark counts where what training texts show there doesn't speak against it
        inside = [f <= FLOORS[1] for f in within]
        harmless = {vocabulary[r] for r, x in zip(rows, v) if x[inside].any() and df[0, r] and not df[1, r]}
        self.kernel = Kernel(self.landmarks, [min(f, 0.999) for f in starts], inside, harmless)
        own = normalised_kernel([x for x in self.landmarks for _ in range(n)], self.landmarks * n).reshape(n, n).astype(np.float64)
        vals, vecs = np.linalg.eigh(own + 1e-3 * np.eye(n))
        self.map = (vecs / np.sqrt(np.maximum(vals, 1e-3))) @ vecs.T
        self.hot, self.seen, self.old = {}, set(), set()
        # raw words take the largest values of their forms
        r, v = self.kernel.values(vocabulary)
        row = np.full(len(vocabulary), -1)
        row[r] = np.arange(len(r))
        hot = np.flatnonzero(row[flat] >= 0)
        word = np.searchsorted(first, hot, "right") - 1
        value = np.zeros((len(np.unique(word)), n), np.float32)
        at_word = np.full(n_words, -1)
        at_word[np.unique(word)] = np.arange(len(value))
        np.maximum.at(value, at_word[word], v[row[flat[hot]]])
        top, total = np.zeros((len(raw), n)), np.zeros((len(raw), n))
        for i, (at, c) in enumerate(raw):
            k = at_word[at]
            if (k >= 0).any():
                x = value[k[k >= 0]]
                top[i], total[i] = x.max(0), (x * c[k >= 0, None]).sum(0)
        rows = list(self._mapped(top, total, np.array([max(1, c.sum()) for _, c in raw])))
        s = np.where(y > 0, 1.0, -1.0)
        # a toxic text without any landmark teaches nothing
        some = [i for i, r in enumerate(rows) if r.any() or s[i] < 0]
        x, s = [rows[i] for i in some], s[some]
        # landmarks of which texts that are not toxic have none: one alone, misspelt too, makes a text toxic
        at, got = plain.values(vocabulary, inner=False)
        clean = np.array([df[0, at[got[:, k] >= starts[k]]].sum() for k in range(n)])
        sharp = [k for k in range(n) if clean[k] <= 0.001 * nb]
        cores = [self.landmarks[k].strip(OPEN + CLOSE) for k in sharp]
        bent = [f for f in cores] + [f[:i] + c + f[i:] for f in cores if len(f) >= 5 for i in range(1, len(f)) for c in ("x", "z")]
        if any(inside[k] for k in sharp):
            bent += [u + f + w for k, f in zip(sharp, cores) if inside[k] and len(f) >= 5 for u in ("xxx", "zzz") for w in ("", "zzz")]
        taught = [r for size in (8, 200, 2000) for r in self.features([Counter({f: 1, "": size}) for f in bent]) if r.any()]
        x = np.array(x + taught + [np.zeros(len(x[0]))])
        s = np.concatenate((s, np.ones(len(taught)), [-1.0]))
        cost = np.where(s > 0, 0.3 / max(1, (s > 0).sum() - len(taught)), 0.7 / (s < 0).sum()) * len(s)
        if taught:
            cost[-1 - len(taught) : -1] = 0.1 * len(s) / len(taught)
        x1 = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(x1.shape[1])
        ridge = RIDGE * np.eye(len(w))
        ridge[-1, -1] = 1e-6
        for _ in range(50):
            bad = s * (x1 @ w) < 1
            h = (x1[bad] * cost[bad, None]).T
            new = np.linalg.solve(ridge + h @ x1[bad], h @ s[bad])
            if np.allclose(new, w, atol=1e-8):
                break
            w = new
        self.w = w
        self.a = self._curve(x1 @ w, s > 0)
        return self

    @staticmethod
    def _curve(m: np.ndarray, y: np.ndarray) -> float:
        """Platt's logistic fit, with the classes in balance and the middle held at margin 0."""
        t = np.where(y > 0, 1.0, 0.0)
        wt = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        a = 1.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * m, -30, 30)))
            g = (wt * (t - p) * m).sum() - 0.02 * a
            h = (wt * p * (1 - p) * m * m).sum() + 0.02
            a = float(np.clip(a + np.clip(g / h, -1, 1), 0.5, 6))
        return a

    def learn(self, distinct: set[str]) -> None:
        """Remembers the values of raw words; those not met for long are forgotten."""
        new = distinct - self.seen - self.old
        self.seen |= distinct
        if len(self.seen) > MEMORY:
            self.old, self.seen = self.seen, set()
            known = self.old
            self.hot = {w: v for w, v in self.hot.items() if w in known}
        of = {w: forms(w) for w in new}
        vocabulary = sorted(set().union(*of.values())) if of else []
        rows, v = self.kernel.values(vocabulary)
        value = {vocabulary[r]: x for r, x in zip(rows, v)}
        for w, fs in of.items():
            got = [value[f] for f in fs if f in value]
            if got:
                self.hot[w] = np.max(got, axis=0)

    def features(self, docs: list[Counter]) -> np.ndarray:
        """For each document, the mapped largest values, their share of words and their number."""
        self.learn(set().union(*docs))
        n = len(self.landmarks)
        top, total = np.zeros((len(docs), n)), np.zeros((len(docs), n))
        size = np.ones(len(docs))
        for i, d in enumerate(docs):
            hit = d.keys() & self.hot.keys()
            if hit:
                size[i] = d.total()
                for w in hit:
                    v = self.hot[w]
                    np.maximum(top[i], v, out=top[i])
                    total[i] += d[w] * v
        return self._mapped(top, total, size)

    def _mapped(self, top: np.ndarray, total: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Features of documents from largest values, sums of values and numbers of words."""
        share = total / size[:, None]
        every = total.sum(1)
        rate = every / size
        return np.hstack([top @ self.map, (share / (share + HALF)) @ self.map, (total / (total + 2)) @ self.map, (rate / (rate + HALF))[:, None], (every / (every + 2))[:, None]])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities, over whole texts."""
        if not self.landmarks:
            return np.full(len(texts), self.share)
        x = self.features([tokens(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.a * (x @ self.w[:-1] + self.w[-1]), -30, 30)))

    def dumps(self) -> bytes:
        """The model as plain values, without the words it remembers."""
        state = {"share": self.share, "landmarks": self.landmarks}
        if self.landmarks:
            k = self.kernel
            state |= {"kernel": (k.floors.tolist(), k.inside, sorted(k.harmless)), "map": self.map, "w": self.w, "a": self.a}
        return pickle.dumps(state)

    @classmethod
    def loads(cls, blob: bytes) -> Model:
        state = pickle.loads(blob)
        model = cls(state["share"])
        model.landmarks = state["landmarks"]
        if model.landmarks:
            floors, inside, harmless = state["kernel"]
            model.kernel = Kernel(model.landmarks, floors, inside, set(harmless))
            model.map, model.w, model.a = state["map"], state["w"], state["a"]
            model.hot, model.seen, model.old = {}, set(), set()
        return model


def held_out(c="doc_id"):
    return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _told(batches):
    for b in sliced(batches):
        rows = [tokens(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([list(r) for r in rows], pa.list_(pa.string())), pa.array([list(r.values()) for r in rows], pa.list_(pa.int64())), b.column(2)], names=["doc_id", "w", "n", "y"]
        )


def _fitted(batches):
    # in the order of doc_id; words stay in their Arrow lists until their turn
    parts = list(batches)
    if not parts:
        return
    held = pa.Table.from_batches(parts).sort_by("doc_id")
    labels = held.column("y").to_pylist()
    docs = (Counter(dict(zip(w, n))) for b in held.to_batches(max_chunksize=50) for w, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
    blob = Model().fit_tokens(docs, labels).dumps()
    tidy()
    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled rows of each class outside the held-out fold."""
    y = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    order = F.xxhash64("doc_id")
    picked = [y.where(F.col("y") == k).orderBy(order, "doc_id").limit(sample) for k in (1, 0)]
    rows = picked[0].union(picked[1])  # bounded by 2 * sample ids
    found = docs.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(rows), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    told = found.select("doc_id", "text", "y").mapInArrow(_told, "doc_id long, w array<string>, n array<long>, y int")
    blob = told.repartition(1).mapInArrow(_fitted, "model binary").first()
    return Model.loads(blob[0]) if blob else Model()


def _scorer(model: Model, at_text: int, names: list[str]):
    blob = model.dumps()

    def run(batches):
        known = Model.loads(blob)
        for part in sliced(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(known.scores(part.column(at_text).to_pylist()), pa.float64())], names=names)

    return run


def with_score(docs: DataFrame, model: Model, name: str = "_score") -> DataFrame:
    """docs with a score column.  No shuffle."""
    out = docs.withColumn(name, F.lit(0.0))
    return docs.mapInArrow(_scorer(model, docs.columns.index("text"), out.columns), out.schema)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    s = with_score(docs.select("doc_id", "text"), train(docs, labels, sample))
    return s.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are not predicted toxic."""
    name = free_name(docs, "_score")
    return with_score(docs, train(docs, labels, sample), name).where(F.col(name) < 0.5).drop(name)
