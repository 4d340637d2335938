"""Problem 6: each defect, what is no defect, and the tiling against brute force."""

import random

from sheafline.llm.pairs import Prompt, Pushdown, defect, defects_found, language, longest_matches, tiling

BODY = "由小球和木箱组成的系统静置于暗箱，总质量32.0 kg。\n环境温度维持在873 K，电压表的带电量为6.60 μC。\n写出折射率与效率之间的关系式。\nA．电压表读数为30.1 V\nB．动能先增大后减小"
PROMPT = Prompt(BODY)
CASES = {
    None: "empty", "": "empty", " ​\n": "empty", "<p>&nbsp;</p>": "empty", "答案：": "empty", "（待补）": "empty", "N/A": "empty", "……": "empty",
    "抱歉，此题恕难从命，建议自行查阅教材。": "refusal", "> Sorry, I am unable to answer that.": "refusal", "我无法为您提供本题答案": "refusal",
    "解：" + BODY: "copy", "<p>" + BODY.split("\nA")[0] + "</p>": "copy",
    "Option A is correct.": "language", "Тело движется равномерно, поэтому ускорение равно нулю.": "language", "したがって、はやさは134 m/sとわかる。": "language", "Die Kraft beträgt 5.3 N und bleibt.": "language",
    "联立两式消去周期，结果为21.6。\n选取竖直向下为正方向，支持": "truncated", "由动能定理可得动量满足$ E=Bl": "truncated", "<p>第二问中，</p>": "truncated", "代入数据得 v=": "truncated", "所以最终的功率等于": "truncated",
}
FINE = ["B", "ACD", "23.4 kN", "921 mA，沿斜面向下", "\\textbf{功率}：15.20 mA，竖直向下", "![图](a.png)96.4 mA，沿斜面向上", "$ F=ma $", "（1）91.9 N；（2）2.8 m", "由图无法直接读出半径，需要先求动能。", "因此所求结果是 98.00 m/s", "所以半径等于5 N，写出折射率与效率之间的关系式。", "联立两式，结果为5。<pre><code>print(1)</code></pre>", "\\xzanswer{D}"]


def test_defects():
    for text, want in CASES.items():
        assert defect(text, PROMPT, True) == want, text
    for text in FINE:
        assert defect(text, PROMPT, True) is None, text
    assert defect(None, PROMPT, False) is None
    english = Prompt("The cart of mass 5 kg moves on a rough track. Find the tension of the spring.")
    assert defect("Option A is correct.", english, True) is None
    assert defect("选取竖直向下为正方向，支持力为负。", english, True) == "language"
    assert defect("Hence the power of the", english, True) == "truncated"
    assert defect("x", Prompt(None), True) is None


def test_pushdown():
    assert Pushdown("（a[b]）$c(d$ ```(x``` \\begin{e}(\\end{e}").open == []
    assert Pushdown("（a“b”").open == ["（"] and Pushdown("$a").open == ["$"]


def test_languages():
    assert language("已知小车") == "zh" and language("The cart moves") == "en" and language("5 kg, F=ma, AB") == ""
    assert language("原文写作 “ток и сила”。求小车的加速度随时间的变化关系。") == "zh"


def test_tiling_is_no_more_than_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(40)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(40)))
        covered = {k for i in range(len(a) - 5) for k in range(i, i + 6) if a[i : i + 6] in b}
        got = tiling(a, b, 6)
        assert got <= min(len(covered), len(b)) and (got > 0) == bool(covered)
    assert tiling("ab" * 15_000, "ab" * 20_000) == 30_000 and tiling("天" * 500 + "x" * 9, "天" * 100) == 100
    assert tiling("abcdefgh" * 3, "xx" + "abcdefgh" * 3) == 24


def test_long_texts_end():
    import time

    began = time.perf_counter()
    for text in ("\n| a | b |" * 20_000 + "甲乙，丙", "<p>" * 30_000 + "甲乙丙丁", "（" * 30_000 + "甲", BODY * 2000, "х у " * 30_000):
        defect(text, PROMPT, True)
    assert time.perf_counter() - began < 60


def test_rows(spark):
    rows = [(1, BODY, None, None, "x"), (1, BODY, None, None, "x"), (2, None, "B", "", "x"), (3, BODY, "C", "解：" + BODY, "x"), (4, BODY * 300, "D", BODY * 300, "x")]
    df = spark.createDataFrame(rows, "item_id long, body string, answer string, memo string, defect string")
    got = sorted(map(tuple, defects_found(df).collect()))
    assert got == [(1, "answer", "empty"), (1, "answer", "empty"), (2, "memo", "empty"), (3, "memo", "copy"), (4, "memo", "copy")]
    assert defects_found(df.limit(0)).collect() == []


def test_no_length_changes_a_result():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏") for _ in range(n))
    for n in (12, 15, 16, 17, 300, 19990, 20010):
        prompt = text(n)
        edited = "".join(c if i % 23 else "甲" for i, c in enumerate(prompt))
        assert defect(edited if n > 30 else prompt, Prompt(prompt), True) == "copy", n
        assert defect(text(n) + "。", Prompt(prompt), True) is None, n
    unit = text(9)
    for times in (60, 64, 65, 70, 3000):  # one 6-gram stands any number of times
        assert tiling(unit * times, unit * 3) == 27 and tiling(unit * times, unit * times) == 9 * times
    for n in (5, 40, 330, 353, 3000):
        assert defect("抱歉，我无法回答这个问题。" + "因为相关内容需要由任课人员确认，平台没有得到允许。" * (n // 24 + 1), Prompt("求小车的速度"), True) == "refusal"
    assert defect("静摩擦力不能提供足够的向心力，故物体做离心运动。" * 8, Prompt("求小车的速度"), True) is None
    for n in (150, 250, 399, 401, 1200):
        assert defect(f'速度变大，于是小车的动<a title="{"x" * n}">', Prompt("求小车的速度"), True) == "truncated"
        assert defect(f"速度变大，于是小车的动![](figs/{'x' * n}.png)", Prompt("求小车的速度"), True) == "truncated"


def test_tiling_equals_its_definition():
    rng = random.Random(5)
    for _ in range(60):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(2))
        best, at = longest_matches(a, b)
        for i in range(len(a)):
            want = max((k for k in range(len(a) - i + 1) if a[i : i + k] in b), default=0)
            assert best[i] == want and (not want or b[at[i] : at[i] + want] == a[i : i + want])


def test_every_script_is_a_language():
    for text in ("ความเร็วของรถเพิ่มขึ้นตามเวลา", "गाड़ी का वेग समय के साथ बढ़ता है", "המהירות של העגלה גדלה עם הזמן", "η ταχύτητα του οχήματος αυξάνεται με τον χρόνο", "Скорость тележки растёт", "속도가 증가한다 시간에 따라"):
        assert defect(text + "。", Prompt("求小车在水平面上运动的速度与时间的关系。"), True) == "language"
        assert defect(text + ".", Prompt("Find the speed of the cart and the time that it needs."), True) == "language"
    assert defect("μ、Ω 与 α 均为正", Prompt("求小车在水平面上运动的速度与时间的关系。"), True) != "language"
