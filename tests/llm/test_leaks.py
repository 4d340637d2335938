"""Problem 8: the retrieved and verified leaks against brute force."""

import random

from pyspark.sql import functions as F

from sheafline.llm.leaks import ItemIndex, leaks_found
from sheafline.llm.letters import letters


def brute(texts, items, run):
    return sorted((t, d) for t, x in enumerate(texts) for d, y in enumerate(items) if any(y[i : i + run] in x for i in range(len(y) - run + 1)))


def test_equal_to_brute_force():
    rng = random.Random(1)
    for alphabet in ("ab", "abcdefgh", "长为的小车" + "0123456789"):
        word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
        items = [word(rng.randrange(40, 140)) for _ in range(60)] + ["a" * 120]
        texts = ["", "a" * 60]
        for _ in range(150):
            x = rng.choice(items)
            a = rng.randrange(max(1, len(x) - 30))
            texts.append(word(rng.randrange(120)) + x[a : a + rng.randrange(30, 70)] + word(rng.randrange(120)))
        index = ItemIndex(list(enumerate(items)), 50, 12, block=4)
        assert index.leaked(texts) == brute(texts, items, 50)


def test_rows(spark):
    passage = "".join(chr(0x4E00 + i * 7) for i in range(60))
    docs = [(1, "前文，" + "。".join(passage[:55]) + "后文"), (2, passage[:49] + "x" + passage[50:]), (3, None), (4, ""), (5, "z" * 200000 + passage), (5, passage)]
    corpus = spark.createDataFrame([(i, t, "e") for i, t in docs], "doc_id long, text string, eval_id string")
    items = spark.createDataFrame([(7, passage, "a"), (8, "short", "b"), (9, None, "c"), (7, passage, "a")], "eval_id long, text string, answer string")
    want = [(1, 7), (5, 7)]
    assert sorted(map(tuple, leaks_found(corpus, items).collect())) == want
    assert sorted(map(tuple, leaks_found(corpus, items, most_chars=1).collect())) == want
    told = leaks_found(corpus.withColumn("text", F.concat("text", F.lit(" A"))), items, answer="answer").collect()
    assert sorted((r.doc_id, r.eval_id, r.overlap, r.answered) for r in told) == [(1, 7, 55, True), (5, 7, 60, True), (5, 7, 60, True)][: len(told)]
    assert leaks_found(corpus, items.limit(0)).collect() == [] and leaks_found(corpus.limit(0), items).collect() == []
    assert letters("Ab,c") == "abc"


def test_index_is_small_and_quick_to_build():
    rng = random.Random(4)
    items = [(i, "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(500))) for i in range(2000)]
    index = ItemIndex(items)
    assert index.nbytes < 40 * 1_000_000 + (1 << 20)
    assert index.leaked([items[7][1][100:160] + "x", items[9][1][100:149]]) == [(0, 7)]


def test_verify_equals_its_definition():
    rng = random.Random(9)
    for _ in range(300):
        item, text = ("".join(rng.choice("ab") for _ in range(rng.randrange(10, 60))) for _ in range(2))
        index = ItemIndex([(0, item)], 10, 4)
        assert index.verify(text, 0) == any(item[i : i + 10] in text for i in range(len(item) - 9))
