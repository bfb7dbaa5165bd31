import os
import re

import pytest
from pyspark.sql import functions as F
from quirework import __main__ as commands
from quirework.__main__ import run
from quirework.functions.text import rstrip, strip
from quirework.operators import cleanup, layout, merge, order, recognise, split, status
from quirework.sinks.files import page_files
from quirework.sources import files
from quirework.streaming.pages import arriving_pages, done_counts


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


def typeset(spark, text, name="1.a.md"):
    return layout.typeset(spark.createDataFrame([("b", name, text)], "book string, file_name string, text string"), ["book"]).first().text


@pytest.mark.parametrize(
    ("text", "name", "want"),
    [
        ("# T\n甲甲甲是一。\n乙乙\n  丙丙丁丁丙丙丁丁。\nfo-\n续。", "1.a.md", "# T\n\n  甲甲是一。\n\n乙乙\n\n  丙丙丁丁。\n\nfo续。\n"),
        ("甲。\n乙。", "1.a.md", "甲。乙。\n"),
        ("甲。\n乙。", "1.目录.md", "甲。\n\n乙。\n"),
        ("", "1.a.md", "\n"),
        ("a<sup>【x\n y】</sup>b", "1.a.md", None),
    ],
)
def test_typeset_cases(spark, text, name, want):
    if want is not None:
        assert typeset(spark, text, name) == want


def test_cleanup(spark):
    assert one(spark, "a<sup>【x\n y】</sup>b", cleanup.flatten_notes) == "a<sup>【xy】</sup>b"
    assert one(spark, "x</sup>\ny<sup>1</sup>\nz", cleanup.flatten_notes) == "x</sup>\ny<sup>1</sup>\nz"
    assert one(spark, "foofoo the the", cleanup.clean) == "foofoo the the"
    assert one(spark, "哈哈哈哈哈", cleanup.character_runs) == "哈哈"
    assert one(spark, "你好你好你好吗", cleanup.word_repeats) == "你好吗"
    assert one(spark, "　 a\x1c", strip) == "a"


def test_word_repeats_equal_the_pattern(spark):
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choice("甲乙甲乙丙a") for _ in range(rng.randrange(60))) for _ in range(300)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", cleanup.word_repeats(F.col("t")).alias("x")).collect()
    assert {r.i: r.x for r in got} == {i: re.sub(r"([一-龥]{2,})\1+", r"\1", t) for i, t in enumerate(texts)}


def fold_blocks(lines):
    """The scan with state that the window form replaces, in plain words: join or start."""
    blocks = []
    for raw in (x for x in lines if x.strip()):
        s = raw.strip()
        special = raw.startswith(("#", "<sup>", "【", "（")) or "\U0001f004" in raw or re.match(r"\d{4}(\.\.\.)?\s+", s)
        starts = bool(special) or raw.startswith("  ") or (len(s) < 50 and not re.search("[。！？]", s)) or not blocks or blocks[-1].strip().startswith("#")
        if starts:
            after = bool(blocks) and blocks[-1].strip().startswith("#")
            blocks.append("  " + s if after and not special and not raw.startswith("  ") else raw.rstrip())
        else:
            b = blocks[-1].rstrip()
            blocks[-1] = (b[:-1] if b.endswith("-") else b) + s
    return blocks


def test_window_form_equals_the_fold(spark):
    import random

    rng = random.Random(8)
    shapes = ["# t", "  a。", " #x。", "long。" * 3, "w" * 60, "x" * 60 + "-", "short", "<sup>n</sup>。", "【b】。", "1999 y。", "", "🀄️,3。", "（z。"]
    docs = [(i, "\n".join(rng.choice(shapes) for _ in range(rng.randrange(1, 12)))) for i in range(400)]
    lines = merge.to_lines(spark.createDataFrame(docs, "doc long, text string"), ["doc"])
    got = {}
    for r in layout.reflow(lines, ["doc"]).orderBy("doc", "block_no").collect():
        got.setdefault(r.doc, []).append(r.text)
    assert got == {i: b for i, t in docs if (b := fold_blocks(t.split("\n")))}


def test_split(spark):
    docs = spark.createDataFrame([("b", "pre\n# A/B\nx\n## S\n#\n\nC\ny"), ("c", "## A\nx")], "book string, text string")
    got = split.split_chapters(docs, ["book"]).orderBy("idx").collect()
    assert [(r.book, r.file_name, r.text) for r in got] == [("b", "1.A_B.md", "# A/B\nx\n## S\n"), ("b", "2.C.md", "# C\ny")]
    levels = spark.createDataFrame([("c", "A", 1)], "book string, title string, level int")
    lines = split.override_levels(merge.to_lines(docs.where("book = 'c'"), ["book"]), levels, ["book"])
    assert sorted(r.line for r in lines.collect()) == ["# A", "x"]


def test_orders(spark):
    names = ["10.md", "2.md", "5.fail.md", "ch1p10.md", "ch1p9.md"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(order.natural_key(F.col("n")), "n").collect()] == ["2.md", "5.fail.md", "10.md", "ch1p9.md", "ch1p10.md"]
    last = lambda xs: order.contiguous_max(spark.createDataFrame([(x,) for x in xs], "n long"), "n").collect()
    assert last([0, 1, 3])[0].last == 1 and last([1, 2])[0].last == -1


@pytest.mark.parametrize(("done", "want"), [([0, 1, 3], (2, 5)), (range(6), (6, 55)), ([], (0, 5))])
def test_resume(spark, done, want):
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "page_no long")
    assert tuple(status.resume_range(frame(done), frame(range(6))).first()) == want


def test_one_bound_filters_nothing(spark):
    pages = spark.range(6).withColumnRenamed("id", "page_no")
    assert status.in_range(pages, 3, None).count() == 6 and status.in_range(pages, 3, 4).count() == 2


def test_responses(spark):
    e = spark.createDataFrame([(None, ["a", "", "b"])], "t string, p array<string>")
    assert e.select(status.response_text(F.col("t"), F.col("p"))).first()[0] == "a\nb"
    for name, want in (("x.JPG", "image/jpeg"), ("x.tif", "image/tiff"), ("x.gif", "image/jpeg")):
        assert one(spark, name, status.mime_type) == want
    w = status.downscaled(F.lit(1000), F.lit(500), 300) + status.downscaled(F.lit(200), F.lit(100), 300)
    assert tuple(spark.range(1).select(*w).first()) == (300, 150, 200, 100)


def test_attempts():
    answers = iter([{"text": ""}, {"parts": ["", "x", "y"]}])
    assert recognise.attempt(lambda: next(answers), pause=0) == ("x\ny", "ok", 2)
    assert recognise.attempt(lambda: {"finish_reason": "Recitation"}, pause=0) == (None, "fail", 1)
    assert recognise.attempt(lambda: 1 / 0, pause=0) == (None, "error: ZeroDivisionError", 5)


def test_recognise_and_render(spark):
    def reader(content, ext, prompt):
        return {"finish_reason": "PROHIBITED_CONTENT"} if content == b"bad" else {"text": f"{prompt}:{content.decode()}:{ext}"}

    images = spark.createDataFrame([("b", 0, "jpg", b"zero"), ("b", 0, "png", b"late"), ("b", 1, "jpg", b"bad")], "book string, page_no long, ext string, content binary")
    got = page_files(recognise.recognise(images, reader, "p", pause=0)).orderBy("file_name").collect()
    assert [tuple(r) for r in got] == [("0.md", "p:zero:jpg"), ("1.fail.md", "")]
    pdf = spark.createDataFrame([("b", b"ab")], "book string, content binary")
    pages = recognise.render(pdf, lambda c, scale, ext, most: [bytes([x]) for x in c], start=4).orderBy("page_no").collect()
    assert [(r.page_no, bytes(r.content)) for r in pages] == [(4, b"a"), (5, b"b")]


def test_book_from_directory(spark, tmp_path):
    """The commands over files, empty ones too."""
    base = tmp_path / "bk"
    pages = {"0": "# One\n\n  甲。", "1": "", "2": "  丙丙", "5.fail": "", "10": "# One\n乙。\n# Two\nend。\r\nmore。"}
    (base / "ocr-result").mkdir(parents=True)
    for n, t in pages.items():
        (base / "ocr-result" / f"{n}.md").write_text(t, newline="")
    assert files.read_texts(spark, str(base / "ocr-result")).count() == 5
    assert run(["list-fail", "--base-dir", str(base), "--basename-only"], spark) == ["5.jpg"]
    assert run(["list-fail", "--base-dir", str(base)], spark) == ["bk/图片/5.jpg"]
    assert run(["list-fail", "--base-dir", str(tmp_path), "--ocr-dir", str(base / "ocr-result")], spark) == ["bk/图片/5.jpg"]
    (base / "ocr-result" / "05.fail.md").write_text(""), (base / "ocr-result" / f"{10**30}.fail.md").write_text("")
    assert run(["list-fail", "--base-dir", str(base), "--basename-only"], spark) == ["05.jpg", "5.jpg", f"{10**30}.jpg"]
    (base / "ocr-result" / "05.fail.md").unlink(), (base / "ocr-result" / f"{10**30}.fail.md").unlink()
    (tmp_path / "pointer").write_text(f"\n {base} \n")
    run(["merge-rough", "--base-dir-from", str(tmp_path / "pointer")], spark)
    rough = (base / "merge-result/0.rough.md").read_text()
    assert rough == "# One\n\n  甲。\n\n丙丙\n\n乙。\n# Two\nend。\nmore。\n"
    run(["split", "--base-dir", str(base)], spark)
    assert sorted(os.listdir(base / "merge-result")) == ["0.rough.md", "1.One.md", "2.Two.md"]
    run(["typeset", "--base-dir", str(base)], spark)
    run(["merge-final", "--base-dir", str(base)], spark)
    assert (base / "bk.md").read_text() == "# One\n\n  甲。\n\n丙丙乙。\n\n# Two\n\n  end。more。\n"
    run(["typeset", "--base-dir", str(base), "--file-indices", "2", "--output-dir", str(base / "other")], spark)
    assert os.listdir(base / "other") == ["2.Two.md"]
    run(["typeset", "--base-dir", str(base), "--files", "0.rough.md", "1.One.md", "none.md", "--output-dir", str(base / "named")], spark)
    assert os.listdir(base / "named") == ["1.One.md"]


def test_ocr_command(spark, tmp_path, monkeypatch, capsys):
    """Names that are no numbers, mixed case, resume by .md files alone, one file, a book below the base."""

    def read_page(content, ext, prompt):
        return {"candidates": [{"finishReason": "PROHIBITED_CONTENT"}]} if content == b"bad" else {"text": f"{content.decode()} {ext}"}

    base = tmp_path / "bk"
    (base / "images").mkdir(parents=True), (base / "ocr-result").mkdir()
    for name, content in {"0.jpg": "a", "1.Jpg": "b", "2.png": "bad", "03.jpg": "d", "cover.jpg": "c", "back.jpg": "e", f"{10**25}.jpg": "z"}.items():
        (base / "images" / name).write_text(content)
    (base / "ocr-result" / "0.txt").write_text("no page")
    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(commands, "backend", lambda name: read_page)
    backend = ["--backend", "any:function"]
    out = lambda d: {p.name: p.read_text() for p in (base / d).iterdir() if p.suffix == ".md"}
    run(["ocr", "--base-dir", str(tmp_path), "--book-name", "bk", *backend, "--start", "0", "--end", "3"], spark)
    assert out("ocr-result") == {"0.md": "a jpg", "1.md": "b jpg", "2.fail.md": "", "03.md": "d jpg"}
    assert "[4/4][" + "#" * 50 + "][100.00%][OVER]\nfailed pages: 1" in capsys.readouterr().out
    run(["ocr", "--base-dir", str(base), *backend, "--start", "0", "--output-dir", str(base / "all")], spark)
    assert set(out("all")) == {"0.md", "1.md", "2.fail.md", "03.md", "cover.md", "back.md", f"{10**25}.md"} and out("all")["cover.md"] == "c jpg"
    run(["ocr", "--base-dir", str(base), *backend, "--input-file", str(base / "images/cover.jpg"), "--prompt-file", str(tmp_path / "none.md")], spark)
    assert out("ocr-result")["cover.md"] == "c jpg"
    run(["ocr", "--base-dir", str(base), *backend, "--input-file", str(base / "images/2.png"), "--output-file", str(base / "x.md"), "--output-dir", str(base / "one")], spark)
    assert out("one") == {"2.fail.md": ""} and not (base / "x.md").exists()


def test_prompts(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert files.load_prompt(spark, str(tmp_path / "none.md")) == files.load_prompt(spark) == files.DEFAULT_PROMPT
    (tmp_path / "ocr_prompt.md").write_text(" read \n")
    assert files.load_prompt(spark) == "read"


def test_finish_reasons_of_all_shapes():
    from types import SimpleNamespace as N

    class Dumped:
        def __init__(self, method, data):
            setattr(self, method, lambda: data)

    shapes = [
        {"finish_reason": "X"}, N(finish_reason="X"), {"candidates": [{"finishReason": "X"}]}, N(candidates=[N(finish_reason="X")]), N(candidates=[N(finishReason="X")]), N(candidates=[{"finish_reason": "X"}]),
        Dumped("model_dump", {"candidates": [{"finishReason": "X"}]}), Dumped("to_dict", {"candidates": [{"finish_reason": "X"}]}),
    ]
    assert [recognise.finish_reason(s) for s in shapes] == ["X"] * len(shapes)
    assert [recognise.finish_reason(s) for s in ({}, N(candidates=[]), N(candidates=None), Dumped("to_dict", None))] == [""] * 4
    parts = [N(text="a"), N(text=None), {"text": "b"}]
    assert recognise.answer_text(N(text=None, candidates=[N(content=N(parts=parts))])) == "a\nb"


def test_long_numbers_and_names(spark):
    names = [f"{10**40 + 1}.md", f"{10**40}.md", "7.md", "007.md"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(order.natural_key(F.col("n")), "n").collect()] == ["007.md", "7.md", f"{10**40}.md", f"{10**40 + 1}.md"]
    assert one(spark, f"{10**20}.x.md", order.prefix_number) == 2**63 - 1
    listed = spark.createDataFrame([("01.a.md",), ("1.b.md",), ("10.c.md",)], "file_name string")
    assert [r.file_name for r in order.first_match(listed, spark.createDataFrame([(1,)], "idx long")).collect()] == ["1.b.md"]


def test_progress_bar(spark):
    rows = spark.createDataFrame([(1, 3), (3, 3), (5, 4), (0, 0), (1, 100)], "d int, t int").select(status.progress_bar(F.col("d"), F.col("t")).alias("x")).collect()
    assert [r.x for r in rows] == [
        "[1/3][" + "#" * 17 + "-" * 33 + "][33.33%][RUNNING]", "[3/3][" + "#" * 50 + "][100.00%][OVER]", "[5/4][" + "#" * 50 + "][125.00%][OVER]", None, "[1/100][" + "-" * 50 + "][1.00%][RUNNING]",
    ]


def test_strips_are_those_of_python(spark):
    import random

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \t\n\x0b\x1c\x1f\x85\xa0\u2003\u3000\u200b") for _ in range(8)) for _ in range(300)]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", strip("t").alias("s"), rstrip("t").alias("r")).collect()
    assert {r.i: (r.s, r.r) for r in got} == {i: (t.strip(), t.rstrip()) for i, t in enumerate(texts)}


def test_final_merge_keeps_empty_chapters(spark):
    c = spark.createDataFrame([("b", "1.a.md", "x"), ("b", "2.b.md", ""), ("b", "3.c.md", "y")], "book string, file_name string, text string")
    assert merge.final_merge(files.numbered(c), "book", ["number", "file_name"]).first().text == "x\n\n\n\ny\n"


def test_stream_of_pages(spark, tmp_path):
    (tmp_path / "bk").mkdir()
    for n in (0, 1, 4):
        (tmp_path / "bk" / f"{n}.md").write_text("x")
    counts = done_counts(arriving_pages(spark, str(tmp_path / "bk")))
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("counts").collect()] == [("bk", 3, 4)]
