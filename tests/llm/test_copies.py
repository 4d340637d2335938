"""Problem 3: copies against brute force over the keys, and the defined edge cases."""

import itertools
import random

from sheafline.llm.copies import collapse, copies_found, field_labels, find_copies
from sheafline.llm.letters import FieldParser, letters

LABELS = ("题干", "条件", "数据", "设问", "备注")


def test_notations_are_one_key():
    key = FieldParser(LABELS).key
    same = ['【题干】a 1。\n【条件】b-2', '{"条件": "B2", "题干": "A1"}', "- 题干: a1\n- 条件: b 2", "条件：b2；题干：a1。", "题干=a1 | 条件=b.2"]
    assert len({key(x) for x in same}) == 1
    assert key("【题干】b2\n【条件】a1") != key(same[0])
    assert key("题干a1条件b2") != key(same[0]) and key("A b,c") == key("abC") != key("acb")
    assert letters("Ａ_ b² Σς") == "ａb²σσ"


def test_brute_force(spark):
    rng = random.Random(5)
    bodies = [rng.choice(["", "x", "ab 1", "AB,1", "【题干】q\n【条件】w", "题干=q | 条件=w", None, f"u{i}", f"v{i // 3} "]) for i in range(400)]
    rows = [(i * 7 % 1009, b, i) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "bank_id long, body string, copies int")
    key = FieldParser(LABELS).key
    groups = {}
    for i, b, _ in rows:
        if b is not None:
            groups.setdefault(key(b), []).append(i)
    want = sorted((min(g), x) for g in groups.values() for x in g if x != min(g))
    assert sorted(map(tuple, copies_found(df).collect())) == want
    assert sorted(map(tuple, copies_found(df, most_bits=1 << 16, bits_per_row=1).collect())) == want
    assert sorted(map(tuple, copies_found(df, most_bits=1024).collect())) == want  # five shards
    kept = sorted((r.bank_id, r.copies) for r in collapse(df).collect() if r.bank_id == r.duplicateId)
    assert kept == sorted([(min(g), len(g)) for g in groups.values()] + [(i, 1) for i, b, _ in rows if b is None])


def test_filter_passes_few_singles(spark):
    df = spark.range(20000).selectExpr("id as bank_id", "concat('t', id) as body")
    assert find_copies(df)[1].where("maybe").count() < 400
    assert find_copies(df, most_bits=1 << 16)[1].where("maybe").count() < 1200  # more rows than one filter holds
    assert copies_found(df.limit(0)).collect() == [] and collapse(df.limit(0)).collect() == []


def test_repeated_ids_and_hot_group(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "A!")], "bank_id long, body string")
    assert sorted(map(tuple, copies_found(df).collect())) == [(1, 2)]
    hot = spark.range(5000).selectExpr("id as bank_id", "if(id % 3 = 0, 'same', concat('p', cast(id / 2 as int))) as body")
    got = copies_found(hot)
    assert got.where("first_id = 0").count() == 1666


def test_labels_come_from_the_data(spark):
    rows = [(1, "【姓名】甲 【年龄】乙"), (2, "年龄=乙 | 姓名=甲"), (3, '{"年龄": "乙", "姓名": "甲"}'), (4, "姓名：甲；年龄：乙"), (5, "【注】甲：一；乙：二"), (6, "乙：二；甲：一"), (7, None)]
    df = spark.createDataFrame(rows, "bank_id long, body string")
    assert field_labels(df) == ("姓名", "年龄") and field_labels(df.limit(0)) == ()
    assert sorted(map(tuple, copies_found(df).collect())) == [(1, 2), (1, 3), (1, 4)]
