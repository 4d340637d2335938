"""Readers, writers and the resumable stream on small folders."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.operators import parse
from sheafline.sources import sinks
from sheafline.sources import texts as s
from sheafline.streaming.resume import retry, run_available, windowed_counts


def test_files(spark, tmp_path):
    for p, text in {"2020/甲/甲.tex": "a\r\nb", "2020/甲/TikZ/x.tex": "skip", "2021/乙/乙.md": "m", "2021/乙/a.png": "x", "2021/乙/empty.png": ""}.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(text.encode())
    got = s.read_files(spark, str(tmp_path), (".tex", ".md"))
    assert sorted(r.text for r in got.collect()) == ["a\nb", "m"]
    named = s.read_named(spark, [str(tmp_path / "2020/甲/TikZ/x.tex")] * 2)
    assert [r.text for r in named.collect()] == ["skip"]
    files = s.list_files(spark, str(tmp_path))
    assert sorted((r.stem, r.extension) for r in files.collect()) == [("a", "png"), ("x", "tex"), ("乙", "md"), ("甲", "tex")]
    assert s.parents(files, r"\.tex$", r"\.md$").count() == 3
    assert s.page_images(spark.createDataFrame([("page_12",), ("x",)], "stem string")).where("page = 12").count() == 1
    images = spark.createDataFrame([(50, 500), (4000, 200), (300, 300)], "width int, height int")
    assert s.usable_images(images).count() == 1
    pdfs = spark.createDataFrame([("/m/a.pdf", "2020", "2020_甲"), ("/m/b.pdf", "2020", "2020春_甲"), ("/m/q.pdf", "1985", "1985_上海"), ("/m/r.pdf", "旧卷", "旧_甲"), ("/m/s.pdf", "2020", "s")], "path string, year string, stem string")
    assert sorted(r.target for r in s.output_folders(pdfs).collect()) == ["1985/上海", "2020/2020_甲", "2020/2020春_甲", "旧卷/旧_甲"]


def test_json(spark, tmp_path):
    folder = tmp_path / "2020" / "甲"
    folder.mkdir(parents=True)
    (folder / "甲.json").write_text(json.dumps({"items": [{"number": 1, "body": "<p>x</p>"}, {"number": "2", "answer": "B"}]}, ensure_ascii=False))
    (folder / "b.json").write_text("{broken")
    got = s.read_papers(spark, [str(folder / "甲.json"), str(folder / "b.json")]).collect()
    assert sorted((r.number or 0, r.body, r.broken) for r in got if not r.broken)[:1] == [(1, "<p>x</p>", False)] or any(r.broken for r in got)
    assert any(r.broken for r in got)
    texts = ['{"year": "2020", "region": "甲", "entries": [{"number": 3, "problem": "p", "status": "待补充"}]}', '[{"year": "2021", "region": "乙", "entries": [{"number": 4, "problem": "q", "region": "丙"}]}]', '[{"year": "2022", "region": "丁", "question": "5", "problem": "r"}]', "{bad"]
    rows = s.read_reviews(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert sorted((r.year, r.region, r.number, r.problem) for r in rows) == [("2020", "甲", "3", "p"), ("2021", "丙", "4", "q"), ("2022", "丁", "5", "r")]


def test_tables_and_headers(spark):
    doc = "### 2020 年\n| 地区 | 题数 | 状态 | 备注 | 链接 |\n|---|---|---|---|---|\n| 甲 | 12 | 已完成 | | x |\n\n### 2021\n| 乙 | 约3 | 未开始 | n | y |\n"
    df = spark.createDataFrame([("p", doc)], "path string, text string")
    assert sorted(tuple(r) for r in s.progress_rows(df).collect()) == [("2020", "甲", "12", "已完成", "", "x"), ("2021", "乙", "约3", "未开始", "n", "y")]
    ledger = spark.createDataFrame([("p", "## 待补充\n| 甲 | 1 | 缺图 | p | a | 待补充 |\n| a | b |")], "path string, text string")
    assert [tuple(r)[:3] for r in s.ledger_rows(ledger).collect()] == [("待补充", "甲", "1")]
    b = spark.createDataFrame([("p", "- 甲\n  续\n文\n* 乙\n\n  不续")], "path string, text string")
    assert [(r.line, r.item) for r in s.bullets(b, "path").orderBy("line").collect()] == [(1, "甲 续"), (4, "乙")]
    head = '---\ntitle: "甲: 乙"\nsha: 1\nsha: 2\n---\n正文'
    r = spark.createDataFrame([(head,), ("无",)], "t string").select(s.front_matter(F.col("t")), s.body_of(F.col("t"))).collect()
    assert r[0][0] == {"title": "甲: 乙", "sha": "2"} and r[0][1] == "正文" and r[1][0] == {} and r[1][1] == "无"
    listing = "page num type width\n-----\n1 0 image 640 480 rgb 3 8 jpeg no 7 0 150 151 99K 11%\nx 1 image a b c\n2 1 smask 10\n"
    got = s.image_listing(spark.createDataFrame([(listing,)], "text string")).collect()
    assert [tuple(x) for x in got] == [(1, 0, "image", 640, 480, 150, 151)]
    assert s.macros(spark.createDataFrame([("\\NewDocumentCommand \\Ums {} x\n\\NewDocumentCommand \\Ukg {} y",)], "text string")).count() == 2
    log = "Missing character: There is no ① (U+2460) in font abc!\nMissing character: There is no ① (U+2460) in font abc!\n"
    assert [(r.glyph, r.font) for r in s.missing_glyphs(spark.createDataFrame([("l", log)], "path string, text string")).collect()] == [("①", "abc")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2020", "甲", 1), ("2020", "乙", 2)], "year string, region string, n int")
    out = str(tmp_path / "out")
    assert sinks.write_new(df, None, ["year", "region"], out).count() == 2
    more = df.unionByName(spark.createDataFrame([("2021", "甲", 3)], df.schema))
    assert sinks.write_new(more, spark.read.schema(df.schema).parquet(out), ["year", "region"], out).count() == 3 or spark.read.parquet(out).count() == 3
    assert spark.read.parquet(out).count() == 3
    assert sinks.markdown_table(df, ["region", "n"], ["year"], ["n"]).first().table == "| region | n |\n|---|---|\n| 甲 | 1 |\n| 乙 | 2 |"
    pics = spark.createDataFrame([("p", "a.png", 1, b"x")], "doc string, file string, page int, content binary")
    m = sinks.manifest(pics, ["doc"]).first()
    assert m["count"] == 1 and len(m.images[0].sha256) == 64
    found = spark.createDataFrame([("c", "warning", "y", "r", 1, None, "m")], "check string, level string, year string, region string, number long, line long, message string")
    assert sinks.report(found)[1] == 0 and sinks.report(found.withColumn("level", F.lit("error")))[1] == 1 and sinks.report(found.limit(0))[1] == 0
    papers = spark.createDataFrame([("p", "%% number: 1\n%% chapter: 力\n%% body:\nb\n%% answer:\na\n%% memo:\nm")], "id string, text string")
    sinks.write_archive(parse.parse_papers(papers, "id"), "id", str(tmp_path / "archive"))
    assert spark.read.json(str(tmp_path / "archive")).first().chapter == "力"


def test_stream_resumes(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())])
    rows = lambda a, b: spark.range(a, b).selectExpr("id as event_id", "timestamp_seconds(id * 60) as ts")
    rows(0, 10).write.mode("append").parquet(source)
    run_available(spark, schema, source, target, check)
    run_available(spark, schema, source, target, check)
    assert spark.read.parquet(target).count() == 10
    rows(10, 15).write.mode("append").parquet(source)
    run_available(spark, schema, source, target, check)
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == list(range(15))
    counts = windowed_counts(rows(0, 120).withColumn("k", F.lit("a")), "ts", "k")
    assert sorted(r.n for r in counts.collect()) == [60, 60]


def test_retry():
    left = [1, 0]

    def step():
        if left.pop(0):
            raise OSError
        return "ok"

    assert retry(step) == "ok"
    with pytest.raises(OSError):
        retry(lambda: (_ for _ in ()).throw(OSError()), 2)


def test_facts_recipes_registries(spark, tmp_path):
    folder = tmp_path / "2020" / "甲"
    (folder / "figs").mkdir(parents=True)
    for name, text in {"甲.tex": "%% number: 1\n%% number：2\n本题原卷及材料中未提供详解", "a.tex": "x", "figs/1.png": "p", "甲-学生.pdf": "p", "b.log": "Missing character: There is no ② in font f!"}.items():
        (folder / name).write_text(text)
    facts = s.paper_facts(s.read_files(spark, str(tmp_path)), s.list_files(spark, str(tmp_path))).first()
    assert (facts.year, facts.region, facts.questions, facts.figs, facts.student, facts.teacher, facts.placeholder) == ("2020", "甲", 2, 1, True, False, 1)
    assert s.missing_glyphs(s.sibling_logs(spark, [str(folder / "甲.tex")])).first().glyph == "②"
    (tmp_path / "README.md").write_text("r")
    (folder / "n.md").write_text("n")
    listed = s.list_files(spark, str(tmp_path))
    assert s.markdown_roots(listed, str(tmp_path)).count() == 1 and s.markdown_roots(listed, str(tmp_path), ("2020",)).count() == 2
    recipe = '{"entries": [{"source": "s", "trim": {"x": 1}, "erase_labels": "auto", "crops": [{"rect": [0, 1, 2, 3], "target": "t"}, {"rect": [0], "target": "u"}]}, {"source": "q", "trim": false}]}'
    rows = s.read_recipes(spark.createDataFrame([(recipe,), ("{bad",)], "text string")).collect()
    assert sorted((r.source or "", r.target or "", r.x1 or 0, r.trims, r.relabels, r.valid) for r in rows) == [("", "", 0, False, False, False), ("q", "", 0, False, False, False), ("s", "t", 2, True, True, True), ("s", "u", 0, True, True, False)]
    registry = '{"entries": [{"tikz": "a", "original": null}, {"tikz": "b"}, {"tikz": "c", "original": "o", "note": "n"}]}'
    assert sorted((r.tikz, r.original, r.declared) for r in s.read_registry(spark.createDataFrame([(registry,)], "text string")).collect()) == [("a", None, True), ("b", None, False), ("c", "o", True)]


def test_first_table(spark):
    text = "| x |\n文\n| a | b |\n|---|---|\n| 1 | 2 |\n\n| c |"
    df = spark.createDataFrame([(1, text), (2, "无"), (3, None)], "id int, text string")
    assert [(r.line, r.cells) for r in s.first_table(df, "id").collect()] == [(1, ["x"])]
    assert [(r.line, r.cells) for r in s.first_table(df, "id", start=2, end=6).orderBy("line").collect()] == [(3, ["a", "b"]), (4, ["---", "---"]), (5, ["1", "2"])]
