"""MinHash near-dedup with an LSH forest.

Each distinct shingle set has DEEP minimum hashes a tree, cut to lanes of a sort key.  A tree is
one sorted order of these keys, range-partitioned, so neighbours share their longest common
prefix; all trees are one sort.  A run of neighbours that share SHALLOW lanes is a region; where
more than CROWD sets share them, the region is cut at one lane more, up to DEEP.  Neighbours in
one region are candidates: edges are linear in the input, and a region of any size is spread over
tasks by the sort (the neighbours at task borders are linked apart).

Connected candidates are verified on full shingle sets: small components as a whole, large ones
in blocks around a pivot; what the pivot leaves apart is then compared with all members of the
regions it stands in, in blocks, never with the whole component.  No partner, candidate or region
is capped, and no pairs are emitted but those that join two groups.

The similarity that links is a parameter in percent, and the number of trees follows from it: a pair
just at it shares no prefix of 6 with probability 1e-6 at most, and no prefix of 8 with 4e-5 (32
trees for 0.85, 56 for 0.8).  At 0.9 in 32 trees it is 4e-13 and 2e-8.

Defined cases: null text counts as empty; a text without words has an empty set, is linked with
nothing and is its own component; fewer than five words make one shingle of the whole sequence;
equal sets are always linked; a null doc_id never is the smallest unless a component has no
other; fully repeated rows share one verdict, and :func:`deduplicate` keeps one of them; a very
long text is one set as any other; an empty table gives an empty result; extra columns are ignored.
Sets are equal when 128-bit digests of all their shingles are.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, keep_one, materialise, sliced, small_side, text_or_empty

TREES, SHALLOW, DEEP, CROWD = 32, 6, 8, 64
#: A block to verify has at most about so many members and shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1_000_000
#: op9 links from this similarity on, in percent.
WIDTH, PERCENT = 5, 85

_RNG = np.random.default_rng(20240607)
_ODD = _RNG.integers(0, 2**63, TREES * DEEP + 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = _ODD[: TREES * DEEP], _RNG.integers(0, 2**63, TREES * DEEP, dtype=np.uint64) * np.uint64(2)
_P = _ODD[-DEEP - WIDTH : -DEEP]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles (bytes.lower and bytes.split know ASCII only)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WIDTH:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - WIDTH + 1
    s = h[:n] * _P[0]
    for i in range(1, WIDTH):
        s = _mix(s) + h[i : i + n] * _P[i]
    return np.unique(_mix(s))


def tree_count(percent: int) -> int:
    """Trees in which a pair at this similarity is missed with the probabilities above."""
    p = percent / 100
    if p == 1:
        return TREES
    return max(TREES, *(math.ceil(math.log(miss) / math.log(1 - p**depth)) for depth, miss in ((SHALLOW, 1e-6), (DEEP, 4e-5))))


@lru_cache
def _forest(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the hashes; those of the first TREES are fixed."""
    more = np.random.default_rng(20240608).integers(0, 2**63, (max(0, trees - TREES), 2 * DEEP + 1), dtype=np.uint64) * np.uint64(2)
    return np.concatenate((_A, (more[:, DEEP:-1] + np.uint64(1)).ravel())), np.concatenate((_B, more[:, :DEEP].ravel()))


def signature(s: np.ndarray, trees: int = TREES) -> np.ndarray:
    a, b = _forest(trees)
    low = np.full(trees * DEEP, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 128):
        x = s[i : i + 128, None] * a
        x += b
        np.minimum(low, x.min(0), out=low)
    return low


def sort_keys(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tree, its number in 8 bits and four lanes of 14 bits, and four lanes of 16 bits."""
    x = _mix(low.reshape(-1, DEEP))
    a, b = x[:, :4] >> np.uint64(50), x[:, 4:] >> np.uint64(48)
    hi, lo = np.arange(len(x), dtype=np.uint64) << np.uint64(56), np.zeros(len(x), np.uint64)
    for i in range(4):
        hi |= a[:, i] << np.uint64(42 - 14 * i)
        lo |= b[:, i] << np.uint64(48 - 16 * i)
    return hi.view(np.int64), lo.view(np.int64)


_LONGS = pa.list_(pa.int64())
_SIGNED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("node", pa.int64()), ("twin", pa.int64()), ("n_shingles", pa.int64()), ("hi", _LONGS), ("lo", _LONGS)])


def _sign(batches, trees: int):
    """Keys once for each distinct set of a task; copies in other tasks give equal rows."""
    seen: set[bytes] = set()
    for b in sliced(batches):
        nodes, twins, sizes, his, los = [], [], [], [], []
        for t in b.column(2).to_pylist():
            s = shingles(t)
            sizes.append(len(s))
            digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
            nodes.append(digest and int.from_bytes(digest[:8], "little", signed=True))
            twins.append(digest and int.from_bytes(digest[8:], "little", signed=True))
            if digest is None or digest in seen:
                his.append(None), los.append(None)
                continue
            seen.add(digest)
            hi, lo = sort_keys(signature(s, trees))
            his.append(hi), los.append(lo)
        cols = [pa.array(nodes, pa.int64()), pa.array(twins, pa.int64()), pa.array(sizes, pa.int64()), pa.array(his, _LONGS), pa.array(los, _LONGS)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], schema=_SIGNED)


def common_prefix(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """How many lanes each key shares with the next; 0 over the end of a tree."""
    x, y = (hi[1:] ^ hi[:-1]).view(np.uint64), (lo[1:] ^ lo[:-1]).view(np.uint64)
    out = np.zeros(len(x), np.int64)
    for i in range(4):
        out += x < np.uint64(1 << (42 - 14 * i))
    for i in range(4):
        out += (x == 0) & (y < np.uint64(1 << (48 - 16 * i)))
    return out


def _region_id(hi: np.ndarray, lo: np.ndarray, depth: np.ndarray) -> np.ndarray:
    keep = np.uint64(16) * (DEEP - depth).astype(np.uint64)
    cut = (lo.view(np.uint64) >> keep) << keep
    return _mix(_mix(hi.view(np.uint64)) + _mix(cut + depth.astype(np.uint64))).view(np.int64)


def regions(hi: np.ndarray, lo: np.ndarray, crowd: int = CROWD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys: depth, size of the region, whether it holds the key before, whether it reaches an end."""
    n = len(hi)
    lcp = common_prefix(hi, lo)
    depth = np.full(n, SHALLOW)
    for d in range(SHALLOW, DEEP + 1):
        run = np.concatenate(([0], np.cumsum(lcp < d)))
        size = np.bincount(run)[run]
        edge = (run == run[0]) | (run == run[-1])
        if d == SHALLOW:
            sizes, edges = size, edge
        else:
            here = depth == d
            sizes, edges = np.where(here, size, sizes), np.where(here, edge, edges)
        if d < DEEP:
            depth[(depth == d) & (size > crowd)] = d + 1
    return depth, sizes, np.concatenate(([False], lcp >= depth[1:])), edges


_NEAR = pa.schema([("rid", pa.int64()), ("node", pa.int64()), ("prev", pa.int64()), ("n", pa.int64()), ("part", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())])


def _neighbours(batches, crowd: int):
    """One sorted partition: a row for each member of a region, and the first and the last key as they are.

    Regions that reach an end of the partition are told at all depths, as the other side may cut deeper.
    """
    cols = [np.concatenate(x) for x in zip(*([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in batches))]
    if not cols or not len(cols[0]):
        return
    hi, lo, node = (np.ascontiguousarray(c, dtype=np.int64) for c in cols)
    part = TaskContext.get().partitionId()
    empty = lambda n: pa.nulls(n, pa.int64())
    at = [0, len(hi) - 1]
    yield pa.RecordBatch.from_arrays([empty(2), pa.array(node[at]), empty(2), empty(2), pa.array([part] * 2, pa.int64()), pa.array(hi[at]), pa.array(lo[at])], schema=_NEAR)
    depth, size, linked, edge = regions(hi, lo, crowd)
    prev = np.concatenate(([0], node[:-1]))
    for more in range(DEEP - SHALLOW + 1):
        rows = np.flatnonzero((edge | (size > 1)) if not more else edge & (depth + more <= DEEP))
        for a in range(0, len(rows), 100_000):
            r = rows[a : a + 100_000]
            before = pa.array(prev[r], mask=~linked[r]) if not more else empty(len(r))
            yield pa.RecordBatch.from_arrays([pa.array(_region_id(hi[r], lo[r], depth[r] + more)), pa.array(node[r]), before, pa.array(size[r]), empty(len(r)), empty(len(r)), empty(len(r))], schema=_NEAR)


def similar(c, a, b, percent: int = PERCENT):
    """Whether sets of sizes a and b with c common members are linked."""
    return 100 * c >= percent * (a + b - c)


def spanning(nodes: list[int], sets: list[np.ndarray], subs: list[int], ask: list[bool], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Edges that link, over all similar pairs with an asking member, groups that subs holds apart."""
    n = len(nodes)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    mark = np.zeros(codes.max() + 1, np.int32)
    group = np.unique(np.array(subs), return_inverse=True)[1]
    out = []
    for i in np.flatnonzero(ask):
        live = (group != group[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        js = np.flatnonzero(live)
        if not len(js):
            continue
        own = codes[starts[i] : starts[i] + size[i]]
        mark[own] = 1
        if len(js) * 4 > n:
            c = np.add.reduceat(mark[codes], starts)[js]
        else:
            c = np.array([mark[codes[starts[j] : starts[j] + size[j]]].sum() for j in js])
        mark[own] = 0
        for j in js[similar(c.astype(np.int64), size[i], size[js], percent)]:
            if group[j] != group[i]:
                out.append((nodes[i], nodes[j]))
                group[group == group[j]] = group[i]
    return out


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _verify(batches, percent: int):
    """Rows sorted by group key (comp, gi, gj), then node; a group's shingles are held, its texts are not."""
    key, nodes, sets, subs, ask = None, [], [], [], []
    out: list[tuple[int, int]] = []

    def batch():
        a = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], schema=_EDGES)

    for b in sliced(batches):
        cols = [b.column(i).to_pylist() for i in range(6)]
        for *k, node, sub, asks, t in zip(*cols[:3], *cols[3:6], b.column(6).to_pylist()):
            if k != key:
                out += spanning(nodes, sets, subs, ask, percent)
                key, nodes, sets, subs, ask = k, [], [], [], []
            if nodes and nodes[-1] == node:
                ask[-1] |= asks
                continue
            nodes.append(node), sets.append(shingles(t)), subs.append(sub), ask.append(asks)
        if len(out) > 50_000:
            yield batch()
            out.clear()
    out += spanning(nodes, sets, subs, ask, percent)
    yield batch()


def _links(docs: DataFrame, plan: DataFrame, percent: int) -> DataFrame:
    """plan: doc_id, th, comp, gi, gj, node, sub, ask; a row for each block that a member is in."""
    d = docs.select("doc_id", F.xxhash64(text_or_empty("text")).alias("th"), text_or_empty("text").alias("text"))
    plan = small_side(plan.withColumnRenamed("doc_id", "c_id").withColumnRenamed("th", "c_th"), "plan")
    rows = d.join(plan, (F.col("th") == F.col("c_th")) & F.col("doc_id").eqNullSafe(F.col("c_id")))
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.select("comp", "gi", "gj", "node", "sub", "ask", "text").repartition(n, "comp", "gi", "gj").sortWithinPartitions("comp", "gi", "gj", "node")
    return rows.mapInArrow(lambda batches: _verify(batches, percent), "u long, v long")


def forest(signed: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """rid, node, prev, n of every region's members; (u, v) of neighbours over borders of tasks."""
    spark = signed.sparkSession
    keys = signed.where("hi is not null").select("node", F.explode(F.arrays_zip("hi", "lo")).alias("k")).select(F.col("k.hi").alias("hi"), F.col("k.lo").alias("lo"), "node")
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = keys.repartitionByRange(parts, "hi", "lo", "node").sortWithinPartitions("hi", "lo", "node")
    near = materialise(ordered.mapInArrow(lambda batches: _neighbours(batches, crowd), "rid long, node long, prev long, n long, part long, hi long, lo long"), "forest")
    # two rows of each partition, so bounded by their number
    ends = sorted(near.where("part is not null").select("part", "hi", "lo", "node").collect())
    lanes = [common_prefix(np.array([a.hi, b.hi]), np.array([a.lo, b.lo]))[0] for a, b in zip(ends, ends[1:])]
    border = [(a.node, b.node) for a, b, d in zip(ends, ends[1:], lanes) if a.part != b.part and d >= SHALLOW]
    return near.where("rid is not null").select("rid", "node", "prev", "n"), spark.createDataFrame(border, "u long, v long")


def signed_sets(docs: DataFrame, trees: int) -> DataFrame:
    """doc_id, th, node, n_shingles and the trees' keys; a node is one set."""
    texts = docs.select("doc_id", F.xxhash64(text_or_empty("text")).alias("th"), text_or_empty("text").alias("text"))
    signed = materialise(texts.mapInArrow(lambda batches: _sign(batches, trees), "doc_id long, th long, node long, twin long, n_shingles long, hi array<long>, lo array<long>"), "signed")
    clash = signed.where("node is not null").groupBy("node").agg(F.min("twin").alias("a"), F.max("twin").alias("b")).where("a <> b")
    if clash.isEmpty():
        return signed
    # two sets with one 64-bit half: both halves make the node
    return materialise(signed.withColumn("node", F.when(F.col("node").isNotNull(), F.xxhash64("node", "twin"))), "signed-again")


def components(docs: DataFrame, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES, percent: int = PERCENT, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_shingles, component_id, kept."""
    signed = signed_sets(docs, tree_count(percent))
    narrow = signed.select("doc_id", "th", "node", "n_shingles")
    n_docs = signed.count()
    # one row of each distinct set stands for it; which one doesn't matter, min over (doc_id, th) makes it stable
    sets = materialise(narrow.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("r"), F.min("doc_id").alias("low"), F.min("n_shingles").alias("n_shingles"), F.count("*").alias("copies")), "sets", n_docs)
    near, border = forest(signed, crowd)
    cand = connected_components(near.where("prev <> node").select(F.col("node").alias("u"), F.col("prev").alias("v")).union(border), "candidates", most=near.count()).withColumnRenamed("node", "c_node")
    weight = near.groupBy(F.col("node").alias("w_node")).agg(F.sum("n").alias("weight"))
    cand = cand.join(sets, F.col("c_node") == F.col("node")).join(weight, F.col("node") == F.col("w_node"), "left")
    cand = materialise(cand.select("comp", "node", "weight", "n_shingles", F.col("r.doc_id").alias("doc_id"), F.col("r.th").alias("th")), "members")

    blocks = F.ceil(F.greatest(F.count("*") / F.lit(float(block_rows)), F.sum("n_shingles") / F.lit(float(block_shingles)))).cast("int")
    # as a table of its own, so that a hot component's rows can be split in the joins
    comps = materialise(cand.groupBy("comp").agg(blocks.alias("nb"), F.max(F.struct("weight", "node"))["node"].alias("pivot")), "comps", n_docs)
    own = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    placed = cand.join(comps, "comp").withColumn("gi", F.explode(F.when(F.col("node") == F.col("pivot"), F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(F.array(own))))
    placed = placed.select("doc_id", "th", "comp", "gi", F.lit(0).alias("gj"), "node", F.col("node").alias("sub"), F.lit(True).alias("ask"))
    first = materialise(_links(docs, placed, percent), "links")

    # what large candidate components still hold apart, in blocks against all members of its regions
    large = materialise(comps.where("nb > 1").select("comp"), "large")
    links = first
    if not large.isEmpty():
        label = connected_components(first, "first", most=first.count()).select(F.col("node").alias("l_node"), F.col("comp").alias("l"))
        m = cand.join(large, "comp").join(label, F.col("node") == F.col("l_node"), "left").withColumn("sub", F.coalesce("l", "node")).drop("l", "l_node", "weight")
        m = materialise(m, "apart")
        most = materialise(m.groupBy("comp", "sub").agg(F.count("*").alias("k")).groupBy("comp").agg(F.max(F.struct("k", "sub"))["sub"].alias("main")), "main")
        m = m.join(most, "comp").withColumn("ask", F.col("sub") != F.col("main")).withColumnRenamed("node", "m_node").drop("comp", "main")
        rows = materialise(near.select("rid", "node").distinct().join(m, F.col("node") == F.col("m_node")).drop("m_node"), "rows")
        asks = rows.where("ask").groupBy(F.col("rid").alias("r")).agg(blocks.alias("na"))
        mixed = rows.groupBy("rid").agg(blocks.alias("nb"), F.min("sub").alias("a"), F.max("sub").alias("b")).where("a <> b").join(asks, F.col("rid") == F.col("r")).select("rid", "na", "nb")
        rest = rows.join(materialise(mixed, "mixed"), "rid")
        mine = F.pmod(F.xxhash64("node"), F.col("na")).cast("int")
        cols = ["doc_id", "th", F.col("rid").alias("comp"), "gi", "gj", "node", "sub", "ask"]
        every = rest.withColumn("ask", F.lit(False)).withColumn("gi", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("gj", own).select(cols)
        asked = rest.where("ask").withColumn("gi", mine).withColumn("gj", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(cols)
        links = first.union(_links(docs, every.union(asked), percent))

    label = connected_components(links, "links")
    named = sets.join(label.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left").select("node", "low", "copies", "comp")
    named = materialise(named.where("comp is not null or copies > 1"), "named", n_docs)
    lows = named.groupBy(F.coalesce("comp", "node").alias("comp")).agg(F.min("low").alias("low"))
    final = named.select("node", F.coalesce("comp", "node").alias("comp")).join(lows, "comp").select(F.col("node").alias("f_node"), F.col("low"))
    out = narrow.join(final, F.col("node") == F.col("f_node"), "left")
    comp = F.when(F.col("f_node").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return out.select("doc_id", "th", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: the smallest doc_id of each component, once."""
    found = materialise(components(docs, percent=percent), "components")
    return keep_one(docs, found, F.xxhash64(text_or_empty(docs["text"])), "th")
