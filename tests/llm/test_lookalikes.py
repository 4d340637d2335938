"""Problem 2: one form, legitimate characters kept, and nothing changes the second time."""

import random
import re
import unicodedata

from sheafline.llm.lookalikes import STABLE, UNSTABLE, unify, unify_fields

CASES = {
    "２４.6 ｋＧ": ("24.6 kG", ["width"]),
    "áb v̄": ("áb v̄", ["combining"]),
    "字​字­﻿": ("字字", ["invisible"]),
    "3 m s ": ("3 m s ", ["space"]),
    "5 Ω µm": ("5 Ω μm", ["sign"]),
    "⾦属⻋": ("金属车", ["radical"]),
    "Тhе сар": ("The cap", ["script"]),
    "38 Ν，68 μС": ("38 N，68 μC", ["script"]),
    "Α．甲\nВ．乙": ("A．甲\nB．乙", ["script"]),
    "其中 х<у 且 у>z": ("其中 x<y 且 y>z", ["script"]),
}
KEPT = ["", "α 粒子与 β 射线，Δt，ω=2π/T，θ，频率 ν", "Тело движется и не стоит", "ток и сила", "m/s² ①②，“甲”（乙）：30°", "v̄ 为均值", "はやさは", "sùdù Köhnel Å", "\U0001f468‍\U0001f469", "&nbsp;"]


def test_cases():
    for text, (want, kinds) in CASES.items():
        assert unify(text) == (want, kinds), text
    for text in KEPT:
        assert unify(text) == (text, []), text


def test_idempotent_and_composed():
    rng = random.Random(9)
    pool = "aеοН1 字́̄​‍１ Ω⾦и.．\n"
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(14)))
        once = unify(text)[0]
        assert unicodedata.is_normalized("NFC", once)
        assert unify(once)[0] == once, ascii(text)


def test_rows(spark):
    df = spark.createDataFrame([(1, "１", None, "x", "k"), (1, "１", None, "x", "k"), (2, None, "", "y" * 50000 + "​", "k")], "item_id long, body string, answer string, memo string, kinds string")
    got = sorted((r.item_id, r.field, r.text[:3], tuple(r.kinds)) for r in unify_fields(df).collect())
    assert got == [(1, "body", "1", ("width",))] * 2 + [(1, "memo", "x", ())] * 2 + [(2, "answer", "", ()), (2, "memo", "yyy", ("invisible",))]
    assert unify_fields(df, only_cases=True).count() == 3
    assert unify_fields(df.limit(0)).collect() == []


def test_quick_check_misses_nothing():
    stable = re.compile(f"[{STABLE}]")
    assert not [hex(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and stable.match(chr(c)) and (UNSTABLE.match(chr(c)) or unicodedata.normalize("NFC", chr(c)) != chr(c))]
    assert not [hex(c) for c in range(0x3000) if not UNSTABLE.match(chr(c)) and unicodedata.normalize("NFC", chr(c)) != chr(c)]


def test_half_width_kana_and_distant_words():
    assert unify("ﾃｽﾄ ｶﾞｽ ﾊﾟ") == ("テスト ガス パ", ["width", "combining"])
    for n in (50, 59, 61, 400):  # a neighbour counts within its sentence, at any distance
        gap = "的" * n
        assert unify(f"слово{gap}ос{gap}")[0] == f"слово{gap}ос{gap}" and unify(f"word{gap}ос{gap}")[0] == f"word{gap}oc{gap}"
