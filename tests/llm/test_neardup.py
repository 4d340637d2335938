"""Problem 5: groups against brute force, under every kind of key, and the edge cases."""

import itertools
import random

import pytest

from sheafline.llm.letters import FieldParser, letters
from sheafline.llm.neardup import components, near_found


def brute(rows, threshold=0.6):
    key = FieldParser(("题干", "条件", "数据", "设问", "备注")).key
    rows = [(i, b) for i, b in dict(rows).items() if b is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    own = {i: letters(b) for i, b in rows}
    grams = {i: {t[k : k + 3] for k in range(len(t) - 2)} for i, t in own.items()}
    for (i, b), (j, c) in itertools.combinations(rows, 2):
        both = grams[i] & grams[j]
        if own[i] == own[j] or key(b) == key(c) or both and len(both) >= threshold * len(grams[i] | grams[j]) - 1e-9:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((find(i), i) for i, _ in rows if find(i) != i)


def corpus(seed, n=220):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdef长为的小车123") for _ in range(k))
    base = [word(rng.randrange(3, 60)) for _ in range(60)]
    rows = []
    for i in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(t) + 1)
            t[k : k + rng.randrange(3)] = word(rng.randrange(3))
        rows.append((i * 7 % 997, "".join(t) + rng.choice(["", " ", "。"])))
    return rows + [(2001, None), (2002, ""), (2003, "ab"), (2004, "a b"), (2005, "【题干】甲乙丙丁\n【条件】一二三四五六七八"), (2006, "条件=一二三四五六七八 | 题干=甲乙丙丁"), (2007, "题干甲乙丙丁，条件一二三四五六七八")]


@pytest.mark.parametrize(("seed", "rare", "block"), [(1, 1000, 4096), (2, 3, 4096), (3, 0, 16), (4, 1000, 8)])
def test_brute_force(spark, seed, rare, block):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, b, "x") for i, b in rows], "bank_id long, body string, label string")
    assert sorted(map(tuple, near_found(df, rare=rare, block=block).collect())) == brute(rows)


def test_one_family_and_empty(spark):
    rng = random.Random(6)
    base = [chr(0x4E00 + rng.randrange(3000)) for _ in range(120)]
    rows = []
    for i in range(400):
        t = list(base)
        t[rng.randrange(120)] = chr(0x4E00 + rng.randrange(3000))
        rows.append((i, "".join(t)))
    df = spark.createDataFrame(rows + rows[:50], "bank_id long, body string")
    assert near_found(df, block=64).count() == 399 and near_found(df).count() == 399
    assert near_found(df.limit(0)).collect() == []


def test_dense_groups_equal_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("天地玄黄宇宙洪荒") for _ in range(6)) for _ in range(14)]
    rows = [(i, "".join(rng.choice(words) for _ in range(9))) for i in range(260)]
    df = spark.createDataFrame(rows, "bank_id long, body string")
    for rare in (3000, 20):
        assert sorted(map(tuple, near_found(df, rare=rare).collect())) == brute(rows)


@pytest.mark.parametrize("rare", [3000, 6])
def test_long_texts(spark, rare):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往") for _ in range(n))
    rows = []
    for i in range(90):
        if i % 3 == 0:
            base = word(rng.choice([40, 500, 560, 700, 1100, 2300]))
        keep = int(len(base) * rng.choice([1, 0.95, 0.7, 0.6]))
        t = list(base[:keep])
        for _ in range(len(t) // 40):
            t[rng.randrange(len(t))] = rng.choice("甲乙丙")
        rows.append((i, "".join(t)))
    df = spark.createDataFrame(rows, "bank_id long, body string")
    assert sorted(map(tuple, near_found(df, rare=rare).collect())) == brute(rows)


@pytest.mark.parametrize("at_once", [0, 20, 1 << 20])
def test_components_of_a_path(spark, at_once):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (5, 5)], "a long, b long")
    got = dict(map(tuple, components(edges, at_once).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_one_id_of_two_bodies(spark):
    base = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往"
    rows = [(3, base), (7, base + "。"), (7, "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳"), (9, "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午")]
    got = near_found(spark.createDataFrame(rows, "bank_id long, body string")).collect()
    assert {(3, 7), (7, 9)} <= set(map(tuple, got)) or {(3, 7), (3, 9)} <= set(map(tuple, got))
