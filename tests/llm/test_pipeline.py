import re

import corpus_pipeline
from quirework.llm import decontam, toxicity
from quirework.llm.common import materialise, read_table

SF = "/root/testdata/sf0.001"
from test_dedup import brute_exact, brute_near  # noqa: E402


def test_stages_match_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns, first = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), name)
        had = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if name != "packing":
            assert out.columns == columns, name
        kept = sorted({r.doc_id for r in out.select("doc_id").collect()})
        if name == "toxicity":
            model = toxicity.train(first, read_table(spark, SF, "labels"))
            want = [d for (d, _), s in zip(had, model.scores([t for _, t in had])) if s < 0.5]
        elif name == "exact_dedup":
            want = [r[0] for r in brute_exact(had) if r[3]]
        elif name == "near_dedup":
            want = [r[0] for r in brute_near(had, 80) if r[3]]
        elif name == "decontamination":
            items = [decontam.normalise(r.text) for r in read_table(spark, SF, "benchmark").collect()]
            want = [d for d, t in had if not any(contains(i, decontam.normalise(t)) for i in items)]
        else:
            want = [d for d, _ in had]
        assert kept == sorted(want), name
        docs = out


def contains(item, text):
    """Whether text has the item within its budget: Sellers' columns in plain integers."""
    k = decontam.budget(len(item))
    if not k:
        return bool(item) and re.search(rf"(?<![^\W_]){re.escape(item)}(?![^\W_])", text) is not None
    if item in text:
        return True
    # a text without any piece can't have it (the pigeonhole), others are measured
    if not any(re.search(re.escape(p), text) for _, p in decontam.cut(item, k)):
        return False
    col = list(range(len(item) + 1))
    for c in text:
        last, col[0] = 0, 0
        for i, a in enumerate(item, 1):
            last, col[i] = col[i], min(col[i] + 1, col[i - 1] + 1, last + (a != c))
        if col[-1] <= k:
            return True
    return False


def test_stages_take_odd_tables(spark):
    """Nulls, repeated rows, clashing extra columns and empty tables at every stage."""
    rows = [(1, None, "x", None, 0), (2, "", "x", "s", 0), (3, "one two three four five six " * 20, None, "s", 1), (3, "one two three four five six " * 20, None, "s", 1), (None, "w " * 30_000, "x", "s", 2)]
    names = "doc_id long, text string, lang string, source string, n_chars long, _items string, _score double, _at int, _k int, kept boolean, node long"
    docs = spark.createDataFrame([(*r, "i", 1.0, 2, 3, True, 4) for r in rows], names)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            n = out.count()
            assert (n > 0) == (table.count() > 0), name
            if name != "packing":
                assert out.columns == docs.columns, name
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    assert ids(corpus_pipeline.drop_exact_copies(spark, docs, SF)) == [1, 3, None]
