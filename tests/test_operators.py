"""Parsing, rules, joins, aggregates, ordered operators and merges on archive-shaped fixtures."""

import random

import numpy as np
from pyspark.sql import functions as F

from sheafline import schema
from sheafline.operators import aggregates as ag
from sheafline.operators import joins, merge, ordered, parse, rasters, rules, sets
from sheafline.sources import sinks

PAPER = r"""%% sourceNumbers: 17, 19
\documentclass[\paperver]{exampaper}
\begin{document}
\chapter{题}
%% number: 1
%% paperName: 甲
%% paperName: 乙
%% typeId: 1
%% type: 单选题
%% body:
题干\ref{2020甲01} \onepicture[label=2020甲02]{figs/01}
%% answer: A
\xzanswer{A}
%% memo:
\memoanswer{由①②式得 $a$ ①。 如图 \fourchoices[answer=B]}
%% number：2
%% typeId: 6
%% body:
\begin{enumerate}
\item 甲
\item 乙
\end{enumerate}
速度 m/s 与 \Uxx \vfill 中文,中文
%% answer:
\jdanswer{
\begin{enumerate}
\item 一
\end{enumerate}
}
%% memo:
\memoanswer[某]{x ①，y ③。}
\end{document}
"""


def paper(spark):
    return spark.createDataFrame([("2020", "甲", PAPER)], "year string, region string, text string")


def items(spark):
    df = paper(spark).withColumn("id", F.struct("year", "region"))
    out = parse.item_blocks(df, "id").withColumn("m", parse.metadata(F.col("block")))
    return out.select("id.year", "id.region", "number", "block", F.col("m")["typeId"].try_cast("long").alias("typeId"), F.col("m")["type"].alias("type"), parse.section(F.col("block"), "%% memo:", None).alias("memo"))


def test_parse(spark):
    got = parse.parse_papers(paper(spark), "region").orderBy("pos").collect()
    assert [r.number for r in got] == [1, 2]
    assert got[0].meta["paperName"] == "乙" and got[0].body.startswith("题干") and got[0].answer == "\\xzanswer{A}"
    assert parse.item_blocks(paper(spark), "region", strict=True).count() == 1
    assert paper(spark).select(parse.source_numbers(F.col("text"))).first()[0] == [17, 19]
    nested = parse.collect_papers(parse.parse_papers(paper(spark), "region"), "region").first()
    assert [i.number for i in nested["items"]] == [1, 2]
    assert parse.parse_papers(paper(spark).withColumn("text", F.lit("")), "region").count() == 0


def test_paragraphs_and_options(spark):
    df = spark.createDataFrame([(1, "<p>题干</p><p>&nbsp;</p><p>A．甲</p><p>C．乙</p><p>B．<img src='x.png'></p><p>（1）问</p>"), (2, None), (3, "")], "id int, h string")
    assert [r.n for r in df.orderBy("id").select(F.size(parse.paragraphs(F.coalesce("h", F.lit("")))).alias("n")).collect()] == [5, 0, 0]
    got = [(r.kind, r.label) for r in parse.classify_paragraphs(df, "id", "h").where("id = 1").orderBy("pos").collect()]
    assert got == [("stem", ""), ("option", "A"), ("question", ""), ("image_option", ""), ("question", "")]
    assert parse.classify(["题", "A．甲 B． 乙", "C． 丙 D． 丁", "（1）问"]) == [("stem", "", "题"), ("option", "A", "甲"), ("option", "B", "乙"), ("option", "C", "丙"), ("option", "D", "丁"), ("question", "", "（1）问")]
    assert parse.classify(["题（A）甲（B）乙", "（1）问", "A", "完"], False) == [("option", "A", "甲"), ("option", "B", "乙"), ("question", "", "（1）问"), ("question", "", "A"), ("question", "", "完")]
    assert parse.classify(["（1）问", "完"], False) == [("question", "", "（1）问"), ("stem", "", "完")] and parse.classify(["（1）问", "B．"]) == [("stem", "", "（1）问"), ("option", "B", "")]
    o = spark.createDataFrame([("求。 （A）5 m B．6 C、7",), ("无",)], "x string").select(parse.options(F.col("x")).alias("o")).collect()
    assert [(x.label, x.value) for x in o[0].o] == [("A", "5 m"), ("B", "6"), ("C", "7")] and o[1].o == []
    refs = spark.createDataFrame([("<img src='a.png'> ![x](b.png) \\onepicture[h]{c} ![x](b.png) <a href=z>q</a> [t](u)",)], "x string").select(parse.image_refs(F.col("x")), parse.links(F.col("x"))).first()
    assert refs[0] == ["a.png", "b.png", "c"] and refs[1] == ["z", "u"]


def found(df):
    return sorted((r.check, r.level, r.message) for r in df.collect())


def test_paper_rules(spark):
    assert found(rules.skeleton(paper(spark), "exampaper", "paperver")) == []
    bare = spark.createDataFrame([("2020", "乙", "\\begin{figure} pic/x figs/pic/ok")], "year string, region string, text string")
    assert [m for c, _, m in found(rules.skeleton(bare, "exampaper", "paperver"))] == ["no item", "figure", "pic/", "missing begin", "missing chapter", "missing class", "missing end", "missing version switch"]
    assert [(c, m) for c, _, m in found(rules.item_fields(items(spark)))][:2] == [("explanation", "author's only"), ("fields", "number,paperName,paperName,typeId,type,body,answer,memo")]
    assert found(rules.label_rules(paper(spark))) == [("label-number", "warning", "label=2020甲02"), ("ref", "error", "2020甲01")]
    assert [(c, m) for c, _, m in found(rules.answer_rules(items(spark)))] == [("answer-count", "2/1")]
    answers = spark.createDataFrame([("2020", "甲", 1, "C")], "year string, region string, number long, answer string")
    assert [(c, m) for c, _, m in found(rules.choice_rules(items(spark), answers))] == [("answer-set", "C"), ("answer-sites", "A,B")]
    assert [(c, m) for c, _, m in found(rules.numbering_rules(items(spark)))] == [("formula-gap", "2"), ("formula-once", "2")]


def test_line_rules(spark):
    own = spark.createDataFrame(
        [("y", "r", i, v) for i, v in enumerate(["速度 5 m/s % m/s", r"\vfill \vfilneg", "$力F$ \\text", r"$x\text{力}$", "中,文", "中A文", r"$\includegraphics{a}$", r"\mathrm{力}", r"\Ums 5", "\\textbf{x}", "中文。", "\\textbf{甲}"], 1)],
        "year string, region string, line long, value string",
    )
    got = sorted((r.check, r.line) for r in rules.line_rules(own).collect())
    assert got == [("layout", 2), ("math-cjk", 3), ("math-picture", 7), ("punctuation", 5), ("roman-cjk", 8), ("spacing", 6), ("unit", 1)]
    assert [r.line for r in rules.paragraph_breaks(own).collect()] == [12]
    macros = spark.createDataFrame([("\\Ums",)], "macro string")
    assert found(rules.unknown_macros(paper(spark), macros)) == [("macro", "error", "Uxx")]
    units = ["kg/m^3", "kW·h", "N\\cdot m", "V/m"]
    plain = ["mg", "n/2", "\\Um/s", "w=6.59cm", "and/or"]
    df = spark.createDataFrame([("y", "r", 1, v) for v in units + plain], "year string, region string, line long, value string")
    assert rules.line_rules(df).where("check = 'unit'").count() == len(units)


def test_every_picture_and_formula(spark):
    """R13, R14, R18, R32 at their edges."""
    row = lambda *v: spark.createDataFrame([("y", "r", i, x) for i, x in enumerate(v, 1)], "year string, region string, line long, value string")
    got = sorted((r.check, r.line) for r in rules.line_rules(row(r"\includegraphics{a} $x \includesvg{b}$ $\includegraphics{c}$", "$$力$$", "$a 力", "价 $5 力 $6")).where("check like 'math%'").collect())
    assert got == [("math-cjk", 2), ("math-cjk", 4), ("math-picture", 1), ("math-picture", 1)]
    text = lambda t: spark.createDataFrame([("y", "r", t)], "year string, region string, text string")
    assert found(rules.math_blocks(text("\\begin{align*}\n力\\text{力}\\end{align*}\\begin{gather}\\text{力}\\includesvg{a}\\end{gather}\\begin{align}力"))) == [("math-cjk", "error", "in an environment"), ("math-picture", "error", "picture in an environment")]
    assert found(rules.unknown_macros(text("% \\Uzzz\n5\\% \\Uyy"), spark.createDataFrame([("\\Ums",)], "macro string"))) == [("macro", "error", "Uyy")]
    memos = ["得①②。", "为v④。", "图象为②。", "①过程开始", "联立①②式", "\\tag{③}", "（2）①从", ""]
    df = spark.createDataFrame(list(enumerate(memos)), "i int, memo string")
    assert [r[0] for r in df.orderBy("i").select(rules.formula_numbers(F.col("memo"))).collect()] == [[2], [4], [], [], [1, 2], [3], [], []]
    items_ = spark.createDataFrame([("y", "r", 1, "由①式得③。①过程")], "year string, region string, number long, memo string")
    assert [(c, m) for c, _, m in found(rules.numbering_rules(items_))] == [("formula-gap", "2"), ("formula-once", "1")]
    bare = spark.createDataFrame([("2020", "乙", "\\documentclass{other} $a\\over b$ %% number: 1")], "year string, region string, text string")
    assert {"missing class", "missing version switch"} <= {m for _, _, m in found(rules.skeleton(bare, "exampaper", "paperver"))}


def test_suggested_units(spark):
    """Each of the seven patterns, its limits, and no comment."""
    lines_ = ["3 m/s^2", "5 m / s", "6 km/h", "1 kg/m^3 与 kg/m3", "2 mA", "3 kPa", "4 eV", "m/s^3 rpm/s m/sec MeV % 5 m/s"]
    df = spark.createDataFrame([("y", "r", i, v) for i, v in enumerate(lines_, 1)], "year string, region string, line long, value string")
    got = sorted((r.line, r.message) for r in rules.suggested_units(df).collect())
    assert got == [(1, "m/s^2"), (2, "m / s"), (3, "km/h"), (4, "kg/m3"), (4, "kg/m^3"), (5, "mA"), (6, "kPa"), (7, "eV")]


def test_registry_material_boxes(spark):
    schema_ = "year string, region string, tikz string, original string"
    entries = spark.createDataFrame([("y", "r", "a", None), ("y", "r", "b", "/x"), ("y", "r", "b", "z")], schema_)
    used = spark.createDataFrame([("y", "r", "a"), ("y", "r", "c")], "year string, region string, tikz string")
    sources = spark.createDataFrame([("y", "r", "d"), ("y", "r", "a")], "year string, region string, tikz string")
    assert [c for c, _, _ in found(rules.registry(entries, used, sources))] == ["orphan", "registry-path", "registry-twice", "unregistered", "unused"]
    expected = spark.createDataFrame([("y", "r", e) for e in ("ocr", "text", "merged")], "year string, region string, element string")
    actual = spark.createDataFrame([("y", "r", "ocr", 5, "h", "h"), ("y", "r", "text", 0, "h", "h"), ("y", "r", "merged", 5, "h", "i")], "year string, region string, element string, length long, stored_hash string, hash string")
    assert [(c, m) for c, _, m in found(rules.material(expected, actual))] == [("drift", "merged"), ("material", "text")]
    b = spark.createDataFrame([("y", "r", 0, 0, 5, 5, 9, 9), ("y", "r", 0, 0, 10, 5, 9, 9), ("y", "r", 3, 3, 3, 5, 9, 9)], "year string, region string, x0 int, y0 int, x1 int, y1 int, w int, h int")
    assert rules.boxes(b).count() == 2


def test_agree_with_others(spark):
    """Odd ids count as much as even ones, and a key of one id is told."""
    rows = [("y", 1, 1, "A"), ("y", 1, 3, "A"), ("y", 1, 5, "B"), ("y", 1, 5, "B"), ("y", 2, 7, "C"), ("y", 3, 2, "A"), ("y", 3, 9, "B"), (None, 4, 11, "D"), (None, 4, 13, "D")]
    df = spark.createDataFrame(rows, "year string, number long, item_id long, answer string")
    got = joins.agree_with_others(df, ["year", "number"], "item_id", "answer").collect()
    assert sorted(map(tuple, got)) == [(2, "A", "differs"), (5, "B", "differs"), (7, "C", "no other side"), (9, "B", "differs")]
    assert joins.agree_with_others(df.limit(0), ["year", "number"], "item_id", "answer").collect() == []


def test_compare_and_joins(spark):
    s = "year string, region string, number long, score long, name string"
    a = spark.createDataFrame([("y", "r", 1, 4, " a  b"), ("y", "r", 2, None, "c"), ("y", "r", 3, 1, "d")], s)
    b = spark.createDataFrame([("y", "r", 1, 5, "a b"), ("y", "r", 2, None, "c"), ("y", "r", 4, 1, "d")], s)
    assert sorted((r.number, r.field, r.left, r.right) for r in joins.compare(a, b, schema.KEY, ["score", "name"]).collect()) == [(1, "score", "4", "5"), (3, "missing_right", None, None), (4, "missing_left", None, None)]
    numbers = spark.createDataFrame([("y", "r", [17, 19])], "year string, region string, sourceNumbers array<long>")
    assert [r.source_number for r in joins.remap(a, numbers).orderBy("number").collect()] == [17, 19, 3]
    files = spark.createDataFrame([("figs/a.svg",), ("figs/b",)], "path string")
    refs = spark.createDataFrame([("figs/a",), ("figs/b",), ("figs/c",)], "path string")
    assert [r.path for r in joins.resolve_files(refs, files).collect()] == ["figs/c"]
    folders = spark.createDataFrame([("/m/2020/x/work", "p.pdf"), ("/n", "p.pdf"), ("/n", "q.pdf")], "folder string, name string")
    pdfs = spark.createDataFrame([("/m/p.pdf", "p.pdf"), ("/m/2020/p.pdf", "p.pdf"), ("/z/q.pdf", "q.pdf")], "path string, name string")
    assert sorted((r.folder, r.name, r.path) for r in joins.longest_prefix(folders, pdfs).collect()) == [("/m/2020/x/work", "p.pdf", "/m/2020/p.pdf"), ("/n", "p.pdf", None), ("/n", "q.pdf", "/z/q.pdf")]
    labels = joins.same_text_label(spark.createDataFrame([("第 一", "a b"), ("二", "c")], "k string, v string"), spark.createDataFrame([("第一", "ab"), ("二", "d")], "k string, v string"), "k", "v")
    assert [tuple(r) for r in labels.collect()] == [("二", "c", "d")]


def test_best_match_scope_and_fallback(spark):
    s = "id long, vec array<double>, source string, page int"
    pool = spark.createDataFrame([(1, [1.0, 0.0, 2.0], "a", 1), (2, [1.0, 0.0, 2.1], "b", 1), (3, [0.0, 1.0, 0.0], "a", 2), (4, [5.0, 5.0, 5.0], "a", 2)], s)
    q = spark.createDataFrame([(10, [1.0, 0.0, 2.1], "b", 1), (11, [1.0, 0.0, 2.0], "a", 2), (12, [7.0, 7.0, 7.0], "z", 9)], s)
    got = {r.query_id: (r.match_id, r.scoped) for r in joins.best_match(q, pool, ["source", "page"], block=2).collect()}
    assert got[10] == (2, True) and got[11] == (1, False) and got[12] == (1, False)  # a flat vector scores 0 everywhere: the smallest id
    assert joins.best_match(q.limit(0), pool, ["source", "page"]).collect() == []


def test_boxes_overlap(spark):
    df = spark.createDataFrame([("e", 1, 0.0, 0.0, 5.0, 5.0), ("e", 2, 4.0, 4.0, 9.0, 9.0), ("e", 3, 5.0, 5.0, 6.0, 6.0), ("f", 4, 0.0, 0.0, 9.0, 9.0)], "g string, id long, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.a, r.b) for r in joins.overlapping(df, ["g"], "id").collect()) == [(1, 2), (2, 3)]


def test_depth_counts(spark):
    texts = {r"\begin{enumerate}\item a\begin{enumerate}\item b\item c\end{enumerate}\item d\end{enumerate}": 2, r"\item x": 0, r"\begin{itemize}\item a\end{itemize}\begin{enumerate}\item b\end{enumerate}": 1, r"\end{enumerate}\begin{enumerate}\item a\items": 1, "": 0}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    assert [r.n for r in df.select("i", ag.outer_items(F.col("x")).alias("n")).orderBy("i").collect()] == list(texts.values())


def test_ordered(spark):
    df = spark.createDataFrame([("p", n) for n in (1, 2, 5, 5, 0, -3)], "k string, n long")
    assert sorted(r.missing for r in ordered.gaps(df, ["k"], "n").collect()) == [3, 4]
    pages = spark.createDataFrame([("d", 1, "<table a><tr>1</tr></table>"), ("d", 2, "<table b><tr>2</tr></table> "), ("d", 3, "文"), ("d", 4, "<table>3</table>")], "d string, page int, html string")
    assert [r.html for r in ordered.merge_tables(pages, ["d"], "page", "html").orderBy("page").collect()] == ["<table a><tr>1</tr><tr>2</tr></table>", "文", "<table>3</table>"]
    names = spark.createDataFrame([(7, 1, "a"), (7, 2, "b"), (7, 3, "a"), (8, 1, "z")], "number int, pos int, src string")
    assert sorted((r.number, r.src, r.code) for r in ordered.first_seen(names, ["number"], "pos", "src").collect()) == [(7, "a", "07a"), (7, "b", "07b"), (8, "z", "08")]
    years = spark.createDataFrame([("2001",), ("2000年以前",), ("未知",), ("1999",)], "y string")
    assert [r.y for r in years.orderBy(ordered.year_rank(F.col("y"))).collect()] == ["2000年以前", "1999", "2001", "未知"]
    steps = ordered.running_depth(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, -1)], "k string, i int, s int"), ["k"], ["i"], F.col("s"))
    assert [r.depth for r in steps.orderBy("i").collect()] == [1, 2, 1]
    rows = spark.createDataFrame([("a", 3, 1, "x"), ("a", 3, 0, "y"), ("a", 1, 2, "z")], "k string, s int, seq int, v string")
    assert ordered.top_by(rows, ["k"], F.col("s"), F.col("seq")).first().v == "y"
    assert [r.s for r in ordered.first_n(rows, ["s"], 1).collect()] == [1]


def test_merges(spark):
    s = "year string, region string, question string, category string, problem string, action string, status string, seq int"
    key = ("y", "r")
    old = spark.createDataFrame([(*key, "1", "c", "p", "a", "待补充", 1), (*key, "2", "c", "p", "a", "待处理", 2), (*key, "3", "c", "p", "a", "待处理", 3), (*key, "5", "c", "p", "a", "已解决", 4)], s)
    new = spark.createDataFrame([(*key, "1", "c", "p", None, "已解决", 1), (*key, "2", "c", "p", "b", "处理中", 2), (*key, "4", "c", "p", "n", "待补充", 3), (*key, "4", "c", "p", "m", "待补充", 4)], s)
    got = {r.question: (r.action, r.status, r.change, r.section) for r in merge.merge_ledger(old, new).collect()}
    assert got == {"1": ("a", "已解决", "moved", 4), "2": ("b", "处理中", "updated", 2), "3": ("a", "待处理", "kept", 2), "4": ("m", "待补充", "added", 1), "5": ("a", "已解决", "kept", 4)}
    flat = merge.append_or_update(old, new, ["year", "region", "question"], ["status"], "seq")
    assert flat.count() == 6 and flat.where("question = '4'").count() == 2
    text = spark.createDataFrame([("x<!-- S -->old<!-- E -->y",), ("none",)], "t string")
    assert [r[0] for r in text.select(merge.replace_block(F.col("t"), "<!-- S -->", "<!-- E -->", F.lit("new"))).collect()] == ["x<!-- S -->\nnew\n<!-- E -->y", "none"]
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a", 5), ("b", 0)], "k string, length int")
    assert sorted(r.k for r in merge.pending(work, done, ["k"]).collect()) == ["b", "c"] and merge.pending(work, done, ["k"], force=True).count() == 3
    assert merge.overlay({"a": {"x": 1, "y": 2}}, {"a": {"y": 3}, "b": 4}) == {"a": {"x": 1, "y": 3}, "b": 4}
    masks = sets.source_masks({c: spark.createDataFrame([(x,) for x in v], "token string") for c, v in {"a": "12", "b": "23", "c": "3"}.items()})
    assert dict(map(tuple, masks.collect())) == {"1": 1, "2": 3, "3": 6} and sets.only_in(masks, 0).first().token == "1"


def test_recipes(spark):
    s = "year string, region string, source string, pos int, x0 long, y0 long, x1 long, y1 long, target string, trims boolean, valid boolean"
    k = ("y", "r")
    crops = spark.createDataFrame([(*k, "a.png", 0, 0, 0, 50, 40, "t1.png", False, True), (*k, "a.png", 1, 40, 30, 90, 80, "t2.png", True, True), (*k, "a.png", 2, 0, 0, 500, 40, "t3.png", False, True), (*k, "b.png", 3, 0, 0, 5, 5, "t1.png", False, True), (*k, "a.png", 4, None, None, None, None, None, False, False)], s)
    pictures = spark.createDataFrame([(*k, "a.png", 100, 100, "png"), (*k, "t1.png", 50, 40, "png"), (*k, "t2.png", 60, 40, "jpg"), (*k, "z.png", 1, 1, "png")], "year string, region string, path string, w int, h int, format string")
    used = spark.createDataFrame([(*k, "q.png")], "year string, region string, path string")
    got = sorted(c for c, _, _ in found(rules.recipes(crops, pictures, used)))
    assert got == ["recipe", "recipe-box", "recipe-format", "recipe-orphan", "recipe-overlap", "recipe-overlap", "recipe-overlap", "recipe-size", "recipe-source", "recipe-target", "recipe-twice"]


def test_links_manifests_documents(spark):
    files = spark.createDataFrame([("/d/a.md",), ("/d/sub/b.png",)], "path string")
    docs = spark.createDataFrame([("/d/a.md", ["sub/b.png", "./sub", "../d/a.md#x", "c.md", "https://x", "#y", "/d/z"])], "path string, links array<string>")
    assert sorted(r.link for r in joins.dead_links(docs, files).collect()) == ["/d/z", "c.md"]
    m = spark.createDataFrame([("p", ["/d/a.md", "/d/no"]), ("q", [])], "source string, images array<string>")
    assert sorted(map(tuple, joins.complete(m, files).collect())) == [("p", 2, 1), ("q", 0, 0)]
    d = spark.createDataFrame([("x.tex", ["01", "02", "01"])], "path string, images array<string>")
    crops = spark.createDataFrame([("s.png", "figs/02.png"), ("s.png", "figs/01.png"), ("t.png", "figs/09.png")], "source string, target string")
    assert [tuple(r) for r in joins.crops_of_documents(d, crops).collect()] == [("x.tex", "s.png", ["figs/01.png", "figs/02.png"])]


def test_material_report(spark):
    df = spark.createDataFrame([("y", "1 2 $a$", "2 3 $b$", "3 4"), ("z", None, "", None)], "year string, a string, b string, c string")
    got = {r.year: r.report.split("\n") for r in sets.material_report(df, ["year"], ("a", "b", "c")).collect()}
    assert got["y"] == ["a alone: 1", "b alone: （无）", "c alone: 4", "a formulas: $a$", "b formulas: $b$"]
    assert all(x.endswith("（无）") for x in got["z"])


def test_boxes_of_all_widths(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        x, y = rng.uniform(-50, 900), rng.uniform(0, 900)
        rows.append(("g" if i % 3 else "h", i, x, y, x + rng.choice([0.5, 3, 20, 900]) * rng.random() + 0.1, y + 40 * rng.random()))
    df = spark.createDataFrame(rows, "g string, id long, x0 double, y0 double, x1 double, y1 double")
    want = sorted((g, a, b) for g, a, ax0, ay0, ax1, ay1 in rows for h, b, bx0, by0, bx1, by1 in rows if g == h and a < b and ax0 < bx1 and bx0 < ax1 and ay0 < by1 and by0 < ay1)
    assert sorted(map(tuple, joins.overlapping(df, ["g"], "id").collect())) == want


def test_located_figures(spark):
    rng = random.Random(6)
    vec = lambda: [rng.gauss(0, 1) for _ in range(16)]
    near = lambda v: [x + rng.gauss(0, 0.05) for x in v]
    a, b, c = vec(), vec(), vec()
    old = spark.createDataFrame([(1, a), (2, b), (3, c)], "id long, vec array<double>")
    crops = spark.createDataFrame([(11, near(a), "s", 1), (12, near(b), "s", 2), (13, near(c), "t", 1)], "id long, vec array<double>, source string, page int")
    pictures = spark.createDataFrame([(21, vec(), "s", 1, "whole"), (22, near(a), "s", 1, "panel0"), (23, near(b), "s", 2, "whole"), (24, vec(), "t", 1, "whole"), (25, near(c), "u", 5, "whole")], "id long, vec array<double>, source string, page int, kind string")
    got = {r.id: (r.crop, r.picture, r.kind) for r in joins.locate_figures(old, crops, pictures).collect()}
    assert got == {1: (11, 22, "panel0"), 2: (12, 23, "whole"), 3: (13, 25, "whole*")}
    for block in (1, 2, 100):
        pairs = joins.nearest(old.withColumn("g", F.col("id") % 2), crops.withColumn("g", F.col("id") % 2), ["g"], block)
        assert {r.query_id: r.match_id for r in pairs.collect()} == {1: 11, 2: 12, 3: 13}
    assert joins.locate_figures(old, crops.limit(0), pictures).where("picture is null").count() == 0


def test_picture_parts_and_drafts(spark):
    import json

    page = np.full((200, 300), 255, np.uint8)
    page[20:90, 20:100] = page[20:90, 160:260] = 0
    df = spark.createDataFrame([("a/x.png", 300, 200, bytearray(page.tobytes())), ("b", 3, 3, bytearray(b"x")), ("c", None, None, None)], "file string, width int, height int, gray binary")
    parts = rasters.picture_parts(df, "file")
    assert [(r.kind, r.x0, r.y0, r.x1, r.y1, len(r.vec)) for r in parts.orderBy("x0").collect()] == [("whole", 0, 0, 300, 200, 1024), ("panel0", 20, 20, 100, 90, 1024), ("panel1", 160, 20, 260, 90, 1024)]
    draft = json.loads(sinks.recipe_drafts(parts.where("kind <> 'whole'"), "figs", "file").first().recipe)
    assert draft == {"entries": [{"source": "a/x.png", "crops": [{"rect": [20, 20, 80, 70], "target": "figs/xa.png"}, {"rect": [160, 20, 100, 70], "target": "figs/xb.png"}]}]}
    listed = rasters.triage(spark.createDataFrame([(1, 0, 0), (2, 1, 3), (3, 4, 2), (4, 4, 1)], "i int, panels int, labels int"))
    assert [r.i for r in listed.collect()] == [4, 3, 2]


def test_writers(spark, tmp_path):
    sources = spark.createDataFrame([("a", "t", "h1", True), ("b", "t", "h2", True), ("c", "t", "h3", True), ("d", None, "h4", False), ("e", "t", "h5", False)], "folder string, text string, hash string, complete boolean")
    stored = spark.createDataFrame([("b", "h2"), ("c", "old"), ("e", "h5")], "folder string, hash string")
    got = dict(map(tuple, sinks.write_material(sources, stored, str(tmp_path / "m")).collect()))
    assert got == {"a": "built", "b": "skipped", "c": "drift", "d": "incomplete", "e": "incomplete"}
    assert [r.folder for r in spark.read.parquet(str(tmp_path / "m")).collect()] == ["a"]
    merged = spark.createDataFrame([(1, "kept"), (2, "added")], "i int, change string")
    assert [r.i for r in sinks.write_ledger(merged, str(tmp_path / "l")).collect()] == [2] and not (tmp_path / "l").exists()
    sinks.write_ledger(merged, str(tmp_path / "l"), write=True)
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2
    sinks.write_matches(spark.createDataFrame([(1, 0.123456)], "id int, score double"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().score == 0.123
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.tex").write_text("8：00")
    (tmp_path / "p" / "b.tex").write_text("甲")
    assert [r.path.rpartition("/")[2] for r in sinks.fix_files(spark, str(tmp_path / "p"), str(tmp_path / "f")).collect()] == ["a.tex"]
    assert [r.text for r in spark.read.parquet(str(tmp_path / "f")).collect()] == ["8:00"] and (tmp_path / "p" / "a.tex").read_text() == "8：00"


def test_registry_files_and_source_numbers(spark):
    key = "year string, region string, tikz string"
    entries = spark.createDataFrame([("y", "r", "a", "figs/1.png"), ("y", "r", "b", "figs/2.png")], key + ", original string")
    used = spark.createDataFrame([("y", "r", "a"), ("y", "q", "z")], key)
    sources = spark.createDataFrame([("y", "r", "a")], key)
    files = spark.createDataFrame([("y", "r", "figs/1.png")], "year string, region string, path string")
    got = sorted((r.check, r.region, r.message) for r in rules.registry(entries, used, sources, files).where("check like 'registry%'").collect())
    assert got == [("registry-missing", "q", "no registry"), ("registry-original", "r", "figs/2.png"), ("registry-source", "q", "z"), ("registry-source", "r", "b")]
    items_ = spark.createDataFrame([("y", "r", n) for n in (1, 2, 4)], "year string, region string, number long")
    lists = spark.createDataFrame([("y", "r", [5, 6])], "year string, region string, sourceNumbers array<int>")
    assert sorted((r.check, r.message) for r in rules.source_numbers(items_, lists).collect()) == [("source-length", "3/2"), ("source-number", "outside the list")]


def test_number_gaps_far_off(spark):
    df = spark.createDataFrame([("a", n) for n in (2, 5, 5, 25_001)] + [("b", 1), ("b", None), ("c", 0)], "k string, n long")
    got = ordered.gaps(df, ["k"], "n")
    assert got.count() == 25_001 - 3 and [r.missing for r in got.orderBy("missing").limit(4).collect()] == [1, 3, 4, 6] and got.where("k <> 'a'").count() == 0
