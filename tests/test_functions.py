"""Text rewrites, conversions and geometry on small cases; a second rewrite changes nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.functions import geometry as g
from sheafline.functions import html as h
from sheafline.functions import text as t
from sheafline.functions.repeat import collapse_tail


def values(spark, make, texts):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("make", "cases"),
    [
        (t.strip_comment, {"a%b": "a", r"5\% x % y": r"5\% x ", "": "", None: None}),
        (t.squeeze, {" a\t\n b　": "a b", None: ""}),
        (t.option_letters, {"<p>A、C</p>": "AC", None: "", "xyz": ""}),
        (t.halfwidth_colon, {"8：00：00 与 1：2": "8:00:00 与 1:2", "٣：４": "٣:４", "答：3": "答：3", "3：甲": "3：甲"}),
        (t.merge_math, {"$x$-$t$": "$x-t$", "$a$–$b$—$c$": "$a-b-c$", "$v$~$t$图": "$v-t$图", "$x$ 与 $t$": "$x$ 与 $t$", "$a$-b": "$a$-b", "$-5$": "$-5$", "5-6": "5-6", "$a": "$a", "$a$-$b$ c $d$": "$a-b$ c $d$", "价格 $5 元，$a$-$b$": "价格 $5 元，$a-b$", "$x\ny$ $a$–$b$-$c$": "$x\ny$ $a-b-c$", "$$": "$$", "$a~b$~$c$": "$a-b-c$"}),
        (t.plain_fraction, {r"\dfrac{1}{2}": r"\frac{1}{2}", r"\dfracX": r"\dfracX"}),
        (t.drop_private, {"ab": "ab"}),
        (t.squeeze_noise, {"甲\nABCD EF\n\n\n\n乙": "甲\nABCD EF\n\n乙", "\n ABC \r\n甲\nAB\n\n\nDIYIZHANG\n\n乙\n": "甲\nAB\n\n乙", None: None}),
        (t.unit_macros, {"3 m/s^2 5 m/s 6 km/h": r"3 \Umsq 5 \Ums 6 \Ukmh", "m/$s^{2}$ m/s2 2 Ω·m": r"\Umsq \Umsq 2 \UOm"}),
        (lambda x: t.answer_bracket(x, F.lit("B")), {"求（　）": "求\\xzanswer{B}", "求（ ）。": "求（ ）。", "求": "求"}),
    ],
)
def test_rewrites(spark, make, cases):
    assert values(spark, make, list(cases)) == list(cases.values())
    if make not in (t.strip_comment,):
        again = [v for v in cases.values() if v]
        assert values(spark, make, again) == again or make is t.option_letters


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, "8：00 $a$-$b$ \\dfrac12"), (2, "无"), (3, None)], "id int, x string")
    out = {r.id: r for r in t.fix_text(df, "x").collect()}
    assert out[1].x == "8:00 $a-b$ \\frac12" and [(c.rule, c.n) for c in out[1].changes] == [("colon", 1), ("math-hyphen", 1), ("fraction", 1)]
    assert out[2].changes == [] and out[3].x is None
    hits = [tuple(r) for r in t.scan_text(spark.createDataFrame([(1, "x\n8：00\n$a$-$b$")], "id int, x string"), "id", "x").orderBy("line").collect()]
    assert hits == [(1, 2, "colon", "8：00"), (1, 3, "math-hyphen", "$a$-$b$")]
    extra = t.Rule("dots", "", r"\.\.\.", lambda c: F.replace(c, F.lit("..."), F.lit("…")))
    t.register(extra)
    try:
        assert t.fix_text(spark.createDataFrame([(1, "a...")], "id int, x string"), "x").first().x == "a…"
        with pytest.raises(ValueError):
            t.register(extra)
    finally:
        t.RULES.remove(extra)


def test_pictures_and_sets(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (list("abcdefghij"),)], "f array<string>")
    got = [r[0] for r in df.select(t.picture_command(F.col("f"))).collect()]
    assert got[:3] == ["", "\\onepicture{a}", "\\twopicture[labelA=figa, labelB=figb]\n{a}\n{b}"] and got[3].count("\\onepicture") == 10
    svg = spark.createDataFrame([(["x/1.svg"],), (["x/1.SVG", "b.png"],)], "f array<string>").select(t.picture_command(F.col("f"), F.lit("2020甲01"), "right")).collect()
    assert [r[0] for r in svg] == ["\\onepicture[align=right]{\\includesvg{x/1}}", "\\twopicture[labelA=2020甲01a, labelB=2020甲01b, align=right]\n{\\includesvg{x/1}}\n{b.png}"]
    assert [r[0] for r in df.limit(3).select(t.set_text(F.col("f"))).collect()] == ["（无）", "a", "a、b"]
    assert values(spark, t.is_placeholder, [None, "", "无。", "没有", "——", "略。", "由图可知"]) == [True] * 5 + [False] * 2


HTML = {
    "<p><em>a</em><sub>1</sub></p>": "$a_{1}$",
    "<p>速度 \\(v\\) 恒定</p>": "速度 $v$ 恒定",
    "<p>功率 \\(P_{总}\\)</p>": "功率 $P_{\\text{总}}$",
    "<p>甲<br>乙</p><!-- x --><script>y</script>丙": "甲\\\\\n乙\n\n丙",
    "a_b 50% A&amp;B 3×4": "a\\_b 50\\% A\\&B 3$\\times$4",
    "<p>10<sup>23</sup> ⑫</p>": "10$^{23}$ \\textcircled{12}",
    "<strong>注意</strong>": "\\textbf{注意}",
    "\\(βg\\)": "$\\beta g$",
    "∀ ⊗ ∽ ∟ º ‑ ⅳ 圧 ﹐": "$\\forall \\otimes \\sim \\perp {^\\circ} -$ iv 压 ，",
    "\\(a⊄b∽ϕⅷ⑫圧\\)": "$a\\nsubseteq b\\backsim\\phi\\text{viii}\\text{\\textcircled{12}}\\text{压}$",
    "\\(5\\% &amp; #\\)": "$5\\% \\& \\#$",
    "<table><tr><td colspan=2>a</td></tr><tr><td>1</td><td>2</td></tr></table>": "\\begin{tabular}{cc}\na &  \\\\\n1 & 2 \\\\\n\\end{tabular}",
    "": "",
}


def test_html(spark):
    for fragment, want in HTML.items():
        assert h.convert(fragment) == want, fragment
    for text in ("<a " * 40_000, "a<br>" * 40_000, "<sup>1</sup>" * 4_000, "<!--" * 40_000, "x < y" * 9):
        assert isinstance(h.convert(text), str)
    assert h.convert("x < y 且 <b>z</b>") == "x < y 且 \\textbf{z}"
    assert h.convert(None) is None and isinstance(h.convert("<p" * 3000), str)
    assert h.blocks('<p>图<img src="x/1.png"></p>', {"1.png": "01.png"}) == ["图\\onepicture{figs/01.png}"]
    assert h.patch_labels("\\put(α){①⑪}") == "\\put($\\alpha$){①\\textcircled{11}}"
    assert h.merge_formulas("$m$$v$$_{0}$ + $mgt$") == "$mv_{0} + mgt$" and h.merge_formulas("$a$, $b$") == "$a$, $b$"
    assert h.merge_formulas("$x^{a}$ $^{b}$") == "$x^{a}$ $^{b}$"
    df = spark.createDataFrame([(1, "<table><tr><td rowspan='2'>a</td><td>b</td></tr><tr><td>c</td></tr></table>"), (2, None), (3, "x")], "id int, html string")
    assert sorted((r.row, r.col, r.text) for r in h.table_cells(df, "id", "html").collect()) == [(1, 1, "a"), (1, 2, "b"), (2, 2, "c")]
    assert [r[0] for r in df.orderBy("id").select(h.html_to_tex(F.col("html"))).collect()][1:] == [None, "x"]


def test_tail():
    text = "".join(chr(0x4E00 + i * 7 % 9000) for i in range(9000))
    assert collapse_tail(text + "循环内容" * 60) == text + "循环内容" and collapse_tail(text + "循环内容" * 60 + "循环") == text + "循环内容循环"
    assert collapse_tail(text + "abcdefghijk" * 20 + "abcd") == text + "abcdefghijk" + "abcd"
    assert collapse_tail(text) == text and collapse_tail("ab" * 100) == "ab" * 100 and collapse_tail(None) is None


def test_numbers(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [1.0, 1.0, 1.0])], "a array<double>, b array<double>, c array<double>")
    r = df.select(F.round(g.centred_cosine(F.col("a"), F.col("b")), 9), g.centred_cosine(F.col("a"), F.col("c"))).first()
    assert tuple(r) == (1.0, 0.0)
    one = spark.range(1)
    lit = F.lit
    assert one.select(g.grid_box(lit(-5), lit(100), lit(500), lit(900), lit(200), lit(100))).first()[0].asDict() == {"x0": 0, "y0": 10, "x1": 100, "y1": 90}
    assert one.select(g.grid_box(lit(5), lit(5), lit(5), lit(9), lit(100), lit(100))).first()[0] is None
    assert one.select(g.label_padding(lit(25), lit(9))).first()[0] == 4 and one.select(g.label_padding(lit(250), lit(9))).first()[0] == 25
    assert tuple(one.select(g.fit_within(lit(4000), lit(1000), 1000)).first()[0]) == (1000, 250)
    assert tuple(one.select(g.picture_size(lit("width:800px;height:400px"))).first()[0]) == (430.0, 215.0)
    assert [one.select(g.version_at_least(lit(v), 1, 2)).first()[0] for v in ("v1.10", "1.1", "x", "2.0")] == [True, False, False, True]
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452000000200000001000")
    r = spark.createDataFrame([(png,), (b"\xff\xd8\xff",), (b"<svg>",), (b"",)], "b binary").select(g.sniff(F.col("b")).alias("k"), g.png_size(F.col("b")).alias("s")).collect()
    assert [x.k for x in r] == ["png", "jpg", "svg", None] and tuple(r[0].s) == (32, 16)


def test_rasters():
    page = np.full((200, 300), 255, np.uint8)
    page[20:80, 20:100] = page[20:80, 160:260] = page[120:180, 40:200] = 0
    assert g.panels(page) == [(20, 20, 100, 80), (160, 20, 260, 80), (40, 120, 200, 180)]
    assert g.ink_share(page, (20, 20, 100, 80)) == 1.0 and g.ink_share(page, (0, 0, 0, 0)) == 0.0
    square, cross = np.full((64, 64), 255, np.uint8), np.full((64, 64), 255, np.uint8)
    square[10:54, 10:54] = 0
    cross[28:36, 4:60] = cross[4:60, 28:36] = 0
    a, b, c = (g.normalise_raster(x).ravel() for x in (square, cross, np.roll(square, 5, 1)))
    assert np.corrcoef(a, c)[0, 1] > 0.99 and np.corrcoef(a, b)[0, 1] < 0.9
    assert not g.normalise_raster(np.full((5, 5), 255, np.uint8)).any()
