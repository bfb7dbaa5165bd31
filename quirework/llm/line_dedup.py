"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

Lines are compared with runs of [\\x20\\x09-\\x0D] as one blank and none at the ends.  The edit bound
is one unit inserted, deleted or replaced: a word in lines of MIN_WORDS words or more, a character in
lines of fewer words that have MIN_CHARS characters or more (long words, addresses, scripts without
blanks); in shorter lines one unit is too large a share, and their bound is zero.  Lines of the two
kinds are not compared with each other.

Every line that may have a neighbour emits the hashes of all its variants with one unit left out,
and of itself; lines that meet in a variant at the same place, or a variant that meets a whole line,
are within the bound.  Groups are aggregated to their earliest line, so no pairs are made inside a
group; each line's earliest partner is then verified by edit distance.  A line goes if it equals, or
is within the bound of, an earlier one; (doc_id, line number) is the order.

A lossless filter comes first: with one edit, two lines share all units of the first or of the
last half, so lines whose halves no other line has emit no variants.

Defined cases: null text counts as empty; blank lines always stay; lines of rows without doc_id come
last, and two of them with one line number are not compared unless equal; fully repeated rows share
one verdict; an empty text has one blank line; a very long line has as many variants as units; an
empty table gives an empty result; extra columns are ignored.  Lines are identified by 128 hash bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, materialise, small_side, text_or_empty

MIN_WORDS, MIN_CHARS = 8, 24
#: So many lines (four numbers each) whose text is to be fetched may be broadcast.
FETCH_ROWS = 250_000
_NO_ID = "cast('9223372036854775808' as decimal(20,0))"


def position() -> Column:
    """The order of lines as one number."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.expr(_NO_ID))
    return (doc * F.lit(2147483648).cast("decimal(10,0)") + F.col("line_no")).cast("decimal(38,0)")


def normalised(text: Column) -> Column:
    """Single blanks between words; each step only where a text needs it."""
    odd = text.contains("\t") | text.contains("\x0b") | text.contains("\f") | text.contains("\r")
    t = F.when(odd, F.translate(text, "\t\x0b\f\r", "    ")).otherwise(text)
    return F.when(t.contains("  "), F.regexp_replace(t, " {2,}", " ")).otherwise(t)


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, l of lines that are not blank."""
    x = docs.select("doc_id", normalised(text_or_empty("text")).alias("t"))
    return x.select("doc_id", F.posexplode(F.split("t", "\n")).alias("line_no", "l")).select("doc_id", "line_no", F.trim("l").alias("l")).where("l <> ''")


def kind() -> Column:
    """0 for lines compared by words, 1 by characters, null for lines compared as wholes."""
    return F.expr(f"case when words >= {MIN_WORDS} then 0 when chars >= {MIN_CHARS} then 1 end")


def measured(lines: DataFrame) -> DataFrame:
    """With columns chars, words, kind, units."""
    x = lines.withColumn("chars", F.length("l")).withColumn("words", F.col("chars") - F.length(F.replace("l", F.lit(" "), F.lit(""))) + 1)
    return x.withColumn("kind", kind()).withColumn("units", F.when(F.col("kind") == 0, F.col("words")).otherwise(F.col("chars")))


def _half_keys() -> Column:
    """Hashes of the halves that a line shares with any line within one edit of it."""
    out = []
    for size in ("cast(units div 2 as int)", "cast((units - 1) div 2 as int)"):
        out += [f"xxhash64(0, kind, if(kind = 0, substring_index(l, ' ', {size}), left(l, {size})))", f"xxhash64(1, kind, if(kind = 0, substring_index(l, ' ', -{size}), right(l, {size})))"]
    return F.expr(f"if(kind is not null, array_distinct(array({', '.join(out)})), null)")


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, h, h2, k0..k3 (keys of halves, null without any); blank lines left out.  No text."""
    x = measured(split_lines(docs)).select("doc_id", "line_no", F.xxhash64("l").alias("h"), F.xxhash64(F.lit(1), "l").alias("h2"), _half_keys().alias("k"))
    return x.select("doc_id", "line_no", "h", "h2", *(F.get("k", F.lit(i)).alias(f"k{i}") for i in range(4)))


def within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one edit: what they share at both ends leaves one word at most."""
    na, nb = F.size(a), F.size(b)
    least = F.least(na, nb)
    ends = lambda x, y: F.coalesce(F.nullif(F.array_position(F.zip_with(F.slice(x, F.lit(1), least), F.slice(y, F.lit(1), least), lambda p, q: p == q), F.lit(False)), F.lit(0)) - 1, least.cast("long"))
    return ends(a, b) + ends(F.reverse(a), F.reverse(b)) >= F.greatest(na, nb) - 1


def fetched(docs: DataFrame, alive: DataFrame) -> DataFrame:
    """h, h2, pos, l of each line in alive (doc_id, line_no, h, h2), from the text of its first place."""
    per = alive.groupBy(F.col("doc_id").alias("a_id")).agg(F.collect_list(F.struct("line_no", "h", "h2")).alias("want"))
    x = docs.select("doc_id", text_or_empty("text").alias("text"))
    x = x.join(small_side(per, "wanted", FETCH_ROWS), F.col("doc_id").eqNullSafe(F.col("a_id")))
    x = x.select("doc_id", F.split(normalised(F.col("text")), "\n").alias("t"), "want")
    picked = F.transform("want", lambda w: F.struct(w["line_no"].alias("line_no"), w["h"].alias("h"), w["h2"].alias("h2"), F.trim(F.get("t", w["line_no"])).alias("l")))
    x = x.select("doc_id", F.explode(picked).alias("w")).select("doc_id", "w.line_no", "w.h", "w.h2", "w.l")
    x = x.where((F.xxhash64("l") == F.col("h")) & (F.xxhash64(F.lit(1), "l") == F.col("h2")))
    return x.select("h", "h2", position().alias("pos"), "l").dropDuplicates(["h", "h2"])


def variants(told: DataFrame) -> DataFrame:
    """h, pos, i, v: hashes of each line (i = 0) and of it without unit i."""
    x = measured(told)
    without = """if(kind = 0,
        concat_ws(' ', nullif(substring_index(l, ' ', i - 1), ''), nullif(substring_index(l, ' ', i - units), '')),
        concat(left(l, i - 1), substring(l, i + 1)))"""
    each = f"transform(sequence(0, units), i -> struct(i, xxhash64(kind, if(i = 0, l, {without})) as v))"
    return x.select("h", "pos", F.explode(F.expr(each)).alias("x")).select("h", "pos", "x.i", "x.v")


def decisions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences (doc_id, line_no, h, h2, pos), and distinct lines that have copies or go: h, h2, first, goes."""
    occ = materialise(occurrences(docs), "occurrences").withColumn("pos", position())
    first = F.min("pos").alias("first")
    distinct = materialise(occ.groupBy("h", "h2").agg(first, F.count("*").alias("n"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(4))), "lines")
    by_key = distinct.select("h", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("k")).where("k is not null")
    shared = by_key.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k")
    alive = by_key.join(shared, "k").select("h", "h2").distinct().join(distinct.select("h", "h2", "first"), ["h", "h2"])
    base = F.lit(2147483648).cast("decimal(10,0)")
    doc = F.floor(F.col("first") / base).cast("decimal(20,0)")
    alive = alive.select(F.when(doc < F.expr(_NO_ID), doc.cast("long")).alias("doc_id"), F.pmod("first", base).cast("int").alias("line_no"), "h", "h2")
    told = materialise(fetched(docs, alive), "told")
    all_of = materialise(variants(told), "variants")
    met = all_of.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    every = materialise(all_of.join(met, "v"), "met")
    discard(all_of)
    # earliest line of each variant and place, and of each variant's whole lines and cut lines
    at = every.groupBy("v", "i").agg(F.min("pos").alias("low"), F.count("*").alias("c"))
    whole = F.min(F.when(F.col("i") == 0, F.col("low"))).alias("whole")
    cut = F.min(F.when(F.col("i") > 0, F.col("low"))).alias("cut")
    per_v = at.groupBy("v").agg(whole, cut).where("whole is not null and cut is not null")
    same = every.join(at.where("i > 0 and c > 1").drop("c"), ["v", "i"]).where("low < pos").select("h", "pos", F.col("low").alias("to"))
    other = every.join(per_v, "v").select("h", "pos", F.when(F.col("i") == 0, F.col("cut")).otherwise(F.col("whole")).alias("to")).where("to < pos")
    pairs = same.union(other).distinct()
    side = measured(told)
    a = side.select(F.col("pos").alias("to"), F.col("l").alias("a"), F.col("kind").alias("a_kind"))
    b = side.select("h", "pos", "h2", F.col("l").alias("b"), "kind")
    both = pairs.join(a, "to").join(b, ["h", "pos"]).where("kind = a_kind")
    near = both.where(F.when(F.col("kind") == 0, within_one(F.split("a", " "), F.split("b", " "))).otherwise(F.levenshtein("a", "b", 1) >= 0))
    near = near.select("h", "h2").distinct().withColumn("goes", F.lit(True))
    marked = distinct.select("h", "h2", "n", "first").join(near, ["h", "h2"], "left").where("n > 1 or goes").select("h", "h2", "first", F.coalesce("goes", F.lit(False)).alias("goes"))
    marked = materialise(marked, "marked")
    discard(every, told, distinct)
    return occ.select("doc_id", "line_no", "h", "h2", "pos"), marked


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines (blank ones too), n_dropped, dropped (line numbers from 0)."""
    occ, marked = decisions(docs)
    gone = occ.join(marked, ["h", "h2"]).where("goes or pos > first").select("doc_id", "line_no").distinct()
    per = gone.groupBy("doc_id").agg(F.array_sort(F.collect_list("line_no")).alias("dropped"))
    text = text_or_empty("text")
    d = docs.select("doc_id", (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    per = per.withColumnRenamed("doc_id", "g_id")
    out = d.join(per, d["doc_id"].eqNullSafe(per["g_id"]), "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(dropped).cast("long").alias("n_dropped"), dropped.alias("dropped"))


def apply(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs with the dropped lines taken out of text; dropped as from verdicts()."""
    at, gone = free_name(docs, "_d"), free_name(docs, "_x")
    d = dropped.where("n_dropped > 0").select(F.col("doc_id").alias(at), F.col("dropped").alias(gone)).dropDuplicates([at])
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n")
    out = docs.join(d, docs["doc_id"].eqNullSafe(d[at]), "left").withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
    return out.select(*docs.columns)
