import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from quirework.llm import exact_dedup, line_dedup, near_dup

WORDS = "sun moon star rain wind leaf root stone river cloud field grass".split()


def words(n, seed=1):
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 16) % len(WORDS)] + str(x % 97))
    return out


def frame(spark, rows):
    """Extra columns clash with names that the operators use inside."""
    names = "doc_id long, text string, h long, th long, node long, recipe string, pos int, _h int, n int, keep_id long"
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5, 6, 7) for r in rows], names)


LONG = " ".join(words(6000, 3))
ROWS = [
    (1, "a b c"), (2, "ab\tc"), (3, "a  b  c "), (4, None), (5, ""), (6, " \n"), (7, LONG), (8, LONG + "\n"), (9, LONG[:-1]),
    (10, "ABC"), (11, "abc é 😀"), (12, "abcé😀"), (13, "a b c"), (13, "a b c"), (None, "solo text"),
]


def brute_exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), float("inf") if d is None else d))
    out = []
    for d, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[n])[1]
        keep = None if keep == float("inf") else keep
        out.append((d, keep, len(groups[n]), d == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_matches_brute_force(spark):
    got = exact_dedup.verdicts(frame(spark, ROWS)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(ROWS)


def test_exact_verifies_colliding_chunks(spark):
    """With a hash that knows two values only, identifiers still tell all chunks apart."""
    rows = [(i, " ".join(words(200, i % 4 + 1))) for i in range(12)]
    got = exact_dedup.verdicts(frame(spark, rows), hash_fn=lambda c: F.xxhash64(c) % 2).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_exact(rows)


def test_chunks_are_content_defined(spark):
    text = "".join(words(3000, 9))
    a, b = spark.createDataFrame([(text,), ("xyz" + text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert "".join(a.c) == text and "".join(b.c) == "xyz" + text
    assert len(set(a.c) & set(b.c)) > 0.8 * len(a.c)


@pytest.mark.parametrize("letters", ["БВГДЗКЛПабвгдезийклмнопрстухцыья", "".join(map(chr, range(0x4E00, 0x9000))), "あいうえおかきくけこのはるんルン", "ABCDEFGHIJKLMNOPRSTUVWZ", "0123456789abcdef"])
def test_chunks_are_content_defined_in_any_script(spark, letters):
    import random

    text = "".join(random.Random(4).choices(letters, k=40_000))
    a, b = spark.createDataFrame([(text,), ("xyz" + text,)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert "".join(a.c) == text and "".join(b.c) == "xyz" + text
    assert len(set(a.c) & set(b.c)) > 0.8 * len(a.c) and len(text) / len(a.c) < 800


def test_exact_deduplicate_keeps_columns(spark):
    docs = frame(spark, ROWS)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 6, 8, 9, 10, 11, None], key=repr)
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_near_edit_of_one_character_is_another_text(spark):
    rows = [(1, LONG), (2, LONG.replace("sun", "Sun", 1))]
    assert [r.kept for r in exact_dedup.verdicts(frame(spark, rows)).collect()] == [True, True]


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and comp[i] != comp[j]:
            a, b = comp[i], comp[j]
            comp = [a if x == b else x for x in comp]
    low = {}
    for c, (d, _) in zip(comp, rows):
        low[c] = min(low.get(c, d), d)
    return sorted((d, len(s), low[c], d == low[c]) for (d, _), s, c in zip(rows, sets, comp))


def near_rows():
    rows, d = [(0, None), (1, ""), (2, " \t "), (3, "One two"), (4, "one TWO"), (5, "one two three four"), (6, "É X"), (7, "é x")], 10
    for g in range(6):
        base = words(120, 50 + g)
        for k in range(8):
            w = list(base)
            for i in range(k * (g % 3)):
                w[(i * 37 + k) % 120] = f"new{g}{k}{i}"
            rows.append((d, " ".join(w)))
            d += 1
    return rows + [(d, LONG), (d + 1, LONG + " end"), (d + 2, LONG), (d + 2, LONG)]


@pytest.mark.parametrize("block_rows", [near_dup.BLOCK_ROWS, 4])
def test_near_matches_brute_force(spark, block_rows):
    """Small blocks send every component through the way of large ones."""
    got = near_dup.components(frame(spark, near_rows()), block_rows=block_rows).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == brute_near(near_rows())


def test_near_template_family(spark):
    """Many sets that share most of a template and are not linked, with copies among them; regions and blocks are tiny."""
    base, rows = words(120, 700), []
    for k in range(60):
        w = list(base)
        for i in range(3):
            w[(i * 40 + k // 2) % 120] = f"own{k // 2 if i < 2 else k}x{i}"
        rows.append((k, " ".join(w)))
    want = brute_near(rows)
    assert 1 < len({r[2] for r in want}) < 60
    got = near_dup.components(frame(spark, rows), block_rows=6, crowd=4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == want


def test_near_links_what_brute_force_links(spark):
    """Recall against all pairs of the documents that share a shingle: every component is the same."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    sets, by, low = {d: shingle_set(t) for d, t in rows}, defaultdict(list), {d: d for d, _ in rows}
    for d, s in sets.items():
        for x in s:
            by[x].append(d)

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in {p for ds in by.values() for p in combinations(sorted(ds), 2)}:
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            low[y] = x
    got = near_dup.components(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: find(d) for d, _ in rows}


def test_regions_of_sorted_keys():
    rng = np.random.default_rng(3)
    low = rng.integers(0, 3, (400, 2 * near_dup.DEEP)).astype(np.uint64)
    low[:200] = low[0]
    low[:200, -4:] = rng.integers(0, 2, (200, 4))
    keys = [near_dup.sort_keys(x) for x in low]
    keys = sorted(zip(np.concatenate([k[0] for k in keys]).tolist(), np.concatenate([k[1] for k in keys]).tolist()))
    hi, lo = (np.array(x, np.int64) for x in zip(*keys))
    lanes = [[(h >> s) & ((1 << n) - 1) for s, n in ((56, 8), (42, 14), (28, 14), (14, 14), (0, 14))] + [(x >> s) & 0xFFFF for s in (48, 32, 16, 0)] for h, x in keys]

    def shared(a, b):
        n = 0
        while n < 9 and lanes[a][n] == lanes[b][n]:
            n += 1
        return max(0, n - 1) if n else 0

    assert near_dup.common_prefix(hi, lo).tolist() == [shared(i, i + 1) for i in range(len(keys) - 1)]
    depth, size, linked, edge = near_dup.regions(hi, lo, crowd=10)
    for i in range(len(keys)):
        d = next(d for d in range(near_dup.SHALLOW, near_dup.DEEP + 1) if d == near_dup.DEEP or sum(shared(i, j) >= d for j in range(len(keys)) if j != i) < 10)
        assert depth[i] == d and size[i] == 1 + sum(shared(i, j) >= d for j in range(len(keys)) if j != i)
        assert linked[i] == (i > 0 and shared(i - 1, i) >= d)
        assert edge[i] == any(i == j or shared(i, j) >= d for j in (0, len(keys) - 1))


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (2, None), (None, "x y"), (None, "x y"), (3, "a b c d e f")]
    docs = frame(spark, rows)
    assert sorted((r.doc_id for r in exact_dedup.deduplicate(docs).collect()), key=repr) == [1, 2, None]
    assert sorted((r.doc_id for r in near_dup.deduplicate(docs).collect()), key=repr) == [1, 2, None]


def test_near_deduplicate_and_empty(spark):
    docs = frame(spark, near_rows())
    kept = near_dup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[0] for r in brute_near(near_rows()) if r[3]})
    assert near_dup.components(docs.limit(0)).count() == 0
    assert near_dup.components(frame(spark, [(None, "a b c d e f"), (None, "a b c d e f")])).count() == 2


def test_near_at_another_similarity(spark):
    """Pairs in 0.80 to 0.85 are linked at 80 percent, and not at 85."""
    rows, d = [], 0
    for g in range(40):
        base = words(150, 900 + g)
        other = base[:60] + [f"new{g}{i}" for i in range(9 + g % 3)] + base[60 + 9 + g % 3 :]
        rows += [(d, " ".join(base)), (d + 1, " ".join(other))]
        d += 2
    sims = [len(a & b) / len(a | b) for a, b in ((shingle_set(rows[i][1]), shingle_set(rows[i + 1][1])) for i in range(0, len(rows), 2))]
    assert all(0.8 <= x < 0.85 for x in sims)
    docs = frame(spark, rows)
    assert sorted(r.doc_id for r in near_dup.deduplicate(docs, percent=80).collect()) == list(range(0, d, 2))
    assert near_dup.deduplicate(docs).count() == len(rows)
    assert near_dup.tree_count(85) == near_dup.TREES and (1 - 0.8**near_dup.DEEP) ** near_dup.tree_count(80) <= 4e-5


def brute_lines(rows):
    """Earlier lines first; a line goes if it equals an earlier one or is one unit's edit from one."""
    last = max((d for d, _ in rows if d is not None), default=0) + 1
    lines = sorted(((last if d is None else d, n, " ".join(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)) for d, t in dict(rows).items() for n, line in enumerate((t or "").split("\n"))), key=lambda x: x[:2])

    def units(line):
        w = line.split(" ")
        if len(w) >= line_dedup.MIN_WORDS:
            return "words", w
        return ("characters", list(line)) if len(line) >= line_dedup.MIN_CHARS else ("whole", None)

    def near(a, b):
        (k, a), (kb, b) = a, b
        if k != kb or k == "whole" or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        s, g = sorted((a, b), key=len)
        return any(g[:i] + g[i + 1 :] == s for i in range(len(g)))

    gone, seen, known = defaultdict(set), [], set()
    for d, n, line in lines:
        u = units(line)
        if line and (line in known or any(near(u, v) for v in seen)):
            gone[d].add(n)
        if line:
            seen.append(u), known.add(line)
    return {d: (len((t or "").split("\n")), sorted(gone[last if d is None else d])) for d, t in rows}


def line_rows():
    base, url, han = words(14, 77), "https://example.org/path/to/some/page?id=1234567", "今天天气很好我们一起去公园散步然后回家吃饭看书睡觉明天继续"
    return [
        (1, " ".join(base) + "\nshort line here\n\n" + " ".join(words(9, 5))),
        (2, " ".join(base[:6] + ["other"] + base[7:]) + "\nshort line there\n\n"),
        (3, " ".join(base[:6] + base[7:]) + "\nshort  line here"),
        (4, " ".join(["pre", *base]) + "\n" + " ".join(base[:-1])),
        (5, " ".join(base[:3] + ["x"] + base[4:9] + ["y"] + base[10:])),
        (6, None), (7, ""), (8, "\n\n"), (9, LONG), (10, LONG + " more"), (11, " ".join(base).replace(" ", "\t")),
        (12, f"{url}\n{han}\n" + " ".join(words(8, 6))), (13, f"{url}8\n{han[:9]}{han[10:]}\n" + " ".join(words(8, 6)[1:])), (14, f"x{url[1:]}\n{han[:4]}雨{han[5:]}"),
        (15, f"{url}89\n{han[:2]}雨雨{han[4:]}\nChapter 1\nChapter 2\n\ttab  twice\r\n tab twice"), (12, f"{url}\n{han}\n" + " ".join(words(8, 6))), (None, f"{url}\nonly here by itself, and long"),
        (16, "a a a a a a a a a a\na a a a a a a a a\na a a a b a a a a a\nb a a a a a a a a a"), (17, "aaaaaaaaaaaaaaaaaaaaaaaaaa\naaaaaaaaaaaaaaaaaaaaaaaaa\naaaaaaabaaaaaaaaaaaaaaaaaaa😀"),
    ]


def test_lines_match_brute_force(spark):
    got = line_dedup.verdicts(frame(spark, line_rows())).collect()
    assert {r.doc_id: (r.n_lines, r.dropped) for r in got} == brute_lines(line_rows())


def test_lines_applied(spark):
    docs = frame(spark, line_rows())
    out = line_dedup.apply(docs, line_dedup.verdicts(docs))
    text = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and text[2] == "short line there\n\n" and text[6] is None and text[11] == ""
    assert line_dedup.verdicts(docs.limit(0)).count() == 0
