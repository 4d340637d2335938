"""Problem 9: finding by kind, what is no case, and surrogates that keep distinctness and coreference."""

import random
import re

import pytest

from sheafline.llm.personal import FAMILY, GIVEN, canonical, check_character, check_id, entities, mentions, personal_found, redact, surrogate


def found(text):
    return [(k, text[a:b]) for a, b, k in mentions(text)]


def test_kinds():
    assert found("来信寄（a.b+1（at）mail.example.org）即可，或 c_d ＠ x.test。") == [("email", "a.b+1（at）mail.example.org"), ("email", "c_d ＠ x.test")]
    assert found("图 figs/04@2x.png，版本 v1@rev2，At 3.5 K") == []
    assert found("电话（0964）4299023，+86 16012022473。１４３０８９８６４６４") == [("phone", "（0964）4299023"), ("phone", "+86 16012022473"), ("phone", "１４３０８９８６４６４")]
    assert found("Call +1 555-017-5342 or (555) 019-8309 or 555.010.5301.") == [("phone", "+1 555-017-5342"), ("phone", "(555) 019-8309"), ("phone", "555.010.5301")]
    assert found("条码776250233172614212，流水号 2018116489076，常数 1.1863537402") == []
    assert found("住在栖岭县清河区石渡路830号4单元883室的考生") == [("address", "栖岭县清河区石渡路830号4单元883室")]
    assert found("小明沿听雨路步行，第19号实验楼") == [] and found("Room 112 holds 5 scans.") == []
    assert found("The office at 354 Millbrook Lane, Unit 3B is closed.") == [("address", "354 Millbrook Lane, Unit 3B")]
    assert found("本题由欧阳杳老师核对。联系人：林栖溪。甲同学与小明同学。") == [("name", "欧阳杳"), ("name", "林栖溪")]
    assert found("Reviewed by Maribeth F. Pellinore. Thanks to Ashgrove, Oswin for it.") == [("name", "Maribeth F. Pellinore"), ("name", "Ashgrove, Oswin")]


def test_citizen_number():
    body = "99464519680116207"
    good = [c for c in "0123456789X" if check_id(body + c)]
    assert len(good) == 1 and not check_id("77625023317261421" + "2")
    assert found(f"证件号码：{body[:6]} {body[6:14]} {body[14:]}{good[0]}。")[0][0] == "id_number"


def test_surrogates_keep_form():
    one = surrogate("phone", "（0964）4299023", canonical("phone", "（0964）4299023"), "", "k")
    assert re.fullmatch(r"（\d{4}）\d{7}", one)
    assert re.sub(r"\D", "", one) == surrogate("phone", "0964-4299023", canonical("phone", "0964-4299023"), "", "k").replace("-", "")
    assert re.fullmatch(r"[A-Z][a-z]+, [A-Z][a-z]+", surrogate("name", "Ashgrove, Oswin", "oswin ashgrove", "f", "k"))
    assert len(surrogate("name", "林栖溪", "林栖溪", "m", "k")) == 3
    assert surrogate("email", "A@B.CD", "a@b.cd", "", "k") != surrogate("email", "A@B.CD", "a@b.cd", "", "j")


def test_rows(spark):
    rows = [(1, "手机：16012022473，手机：+86 16012022473", "x"), (2, None, "x"), (3, "", "x"), (4, "无" * 60000 + "，邮箱：a@b.org。", "x"), (4, "邮箱：a@b.org。", "x"), (5, "录入员林栖溪于当日完成", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    assert sorted(map(tuple, personal_found(df).collect())) == [(1, "phone", "+86 16012022473"), (1, "phone", "16012022473"), (4, "email", "a@b.org"), (5, "name", "林栖溪")]
    out = redact(df, "k").collect()
    assert len(out) == 6
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[2] == [None] and by[3] == [""]
    a, b = re.findall(r"\[PHONE:(?:\+86 )?(\d{11})\]", by[1][0])
    assert a == b != "16012022473"
    assert len({re.search(r"\[EMAIL:[^\]]+\]", t)[0] for t in by[4]}) == 1 and "a@b.org" not in "".join(by[4])
    assert re.fullmatch(r"录入员\[NAME:..?.?\]于当日完成", by[5][0])


def test_clashing_surrogates_stay_apart(spark):
    given = [chr(0x4E00 + i * 13) + chr(0x4E01 + j * 17) for i in range(60) for j in range(60)]
    df = spark.createDataFrame([(i, f"录入员王{g}于当日完成") for i, g in enumerate(given)], "doc_id long, text string")
    n = personal_found(df).select("value").distinct().count()
    assert n > 3000
    assert redact(df, "k").where("text like '%[NAME:%'").select("text").distinct().count() == n
    assert personal_found(df.limit(0)).collect() == [] and redact(df.limit(0), "k").collect() == []


def test_one_surrogate_whatever_the_title(spark):
    """A name with and without a title, in one text and in several, is one entity with one gender."""
    texts = ["录入员林栖溪于当日完成，林栖溪女士核对", "联系人：林栖溪。", "感谢林栖溪小姐。感谢林栖溪先生。", "Reviewed by Ms. Oswina Ashgrove. Thanks to Ashgrove, Oswina for it.", "Author: Oswina Ashgrove."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = " ".join(r.text for r in redact(df, "k").orderBy("doc_id").collect())
    han, latin = re.findall(r"\[NAME:([^\]A-Z]+)\]", out), re.findall(r"\[NAME:([A-Z][^\]]+)\]", out)
    assert len(han) == 5 and len(set(han)) == 1 and han[0] == surrogate("name", "林栖溪", "林栖溪", "f", "k")
    assert len(latin) == 3 and len({" ".join(reversed(x.split(", "))) for x in latin}) == 1 and not any("~" in x for x in han + latin)
    assert latin[0] == surrogate("name", "Oswina Ashgrove", "oswina ashgrove", "f", "k")


def test_one_number_whatever_its_spelling():
    same = ["010-12345678", "+86 10 12345678", "(010)12345678", "+86（010）12345678"]
    assert len({canonical("phone", v) for v in same}) == 1 and len({canonical("phone", v) for v in ("13812345678", "+86 138 1234 5678", "8613812345678")}) == 1
    tails = {re.sub(r"\D", "", surrogate("phone", v, canonical("phone", v), "", "k"))[-10:] for v in same}
    assert len(tails) == 1 and canonical("phone", "1 555 017 5342") == canonical("phone", "(555) 017-5342") == "1-5550175342"
    body = "11010519491231002"
    number = body + check_character(body)
    new = surrogate("id_number", number, number, "", "k")
    assert check_id(new) and new != number and int(new[16]) % 2 == int(body[16]) % 2


def test_surrogates_seldom_clash():
    names = [a + b + c for a in "王李张刘陈" for b in "天地玄黄宇宙洪荒日月盈昃" for c in "辰宿列张寒来暑往秋收冬藏"]
    assert len({surrogate("name", n, n, "", "k") for n in names}) > 0.99 * len(names)
    latin = [f"{a} {b}" for a in map(chr, range(97, 123)) for b in map(chr, range(97, 123))]
    assert len({surrogate("name", n, n, "", "k") for n in latin}) == len(latin)


def test_broadcast_and_join_agree(spark):
    texts = ["录入员林栖溪于当日完成，林栖溪女士核对", "联系人：林栖溪。电话 010-12345678", None, "", "感谢王宁先生。另附。王宁", "林栖溪"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, two = ({r.doc_id: r.text for r in redact(df, "k", at_once=n).collect()} for n in (500_000, -1))
    assert one == two and one[5] == "林栖溪" and one[0].count("[NAME:") == 2
    with pytest.raises(ValueError):
        redact(df, "")


def test_a_name_is_followed_through_its_text():
    text = "录入员林栖溪于当日完成。林栖溪又把林栖溪的记录交来。"
    assert [(e["value"], e["canon"]) for e in entities(text)] == [("林栖溪", "林栖溪")] * 3


def test_names_without_a_cue():
    """Recall on made sentences: common given names are found in running text, rare ones are not (README)."""
    assert found("王小明和李建国去了北京") == [("name", "王小明"), ("name", "李建国")]
    assert found("John Smith met Mary Brown. Mark the point. Grace is here. Frank The") == [("name", "John Smith"), ("name", "Mary Brown")]
    rng = random.Random(2)
    made = lambda pool: rng.choice(FAMILY[19:120]) + rng.choice(pool) + rng.choice(pool)
    common = "".join(GIVEN.values())
    pairs = [(made(common), made(common)) for _ in range(300)]
    text = [f"{a}和{b}在校门口等车。" for a, b in pairs]
    hits = sum(("name", x) in found(t) for t, pair in zip(text, pairs) for x in pair)
    assert hits >= 0.95 * 600
    for t in ("方向和大小在变化", "高度与时间成正比，金属和木块在水面", "马达与电源在通电后", "单位和平均速度", "Scott Road is closed at noon"):
        assert not [x for x in found(t) if x[0] == "name"], t
