"""Problem 4: values and positions, and the vectorised scan against the character scanner."""

import random

import numpy as np
import pyarrow as pa

from sheafline.operators.packed import options, scan, split_rows, unpack


def all_values(bodies, numbers):
    lists, odd = split_rows(pa.array(bodies, pa.string()), np.array(numbers))
    own = [scan(b, bool(n)) if o else v for b, n, o, v in zip(bodies, numbers, odd, lists.to_pylist())]
    return [v if len(v) > 1 else [] for v in own]


def values(body, numbers=False):
    return all_values([body], [numbers])[0]


def test_separators_and_quotes():
    assert values('"a""b，c",d；（e、f） | g/h / i') == ['a"b，c', "d", "（e、f）", "g/h", "i"]
    assert values(",a，，b、") == ["a", "b"]
    assert values("「x；y」\tz\n\n") == ["x；y", "z"]
    assert values("only one") == [] and values("") == [] and values(" ,;\n") == []
    assert values("12 3-4　5", True) == ["12", "3-4", "5"] and values("12 3-4") == []


def test_unpaired_marks_lose_nothing():
    assert values('5" x, 6') == ['5" x', "6"]
    assert values("(a, b") == ["(a", "b"]
    assert values("a), (b, c)") == ["a)", "(b, c)"]
    assert values("（a（b，c）d，e），f") == ["（a（b，c）d，e）", "f"]


def test_long_rows_are_linear():
    for text in ("(a," * 60_000, ")a," * 60_000, '"a,' * 60_001, "（）" * 60_000):
        assert len(values(text)) == len([v for v in scan(text, False)]) or len(scan(text, False)) < 2


def test_options():
    assert options("A．5; B．6 m/s; C．7") == ["5", "6 m/s", "7"]
    assert options("（A）x, y\n(B)z") == ["x, y", "z"]
    assert options(" ".join(f"{c}．{i}" for i, c in enumerate("ABCDEFGHIJKL"))) == [str(i) for i in range(12)]
    assert options("A．甲 C．乙 N．极 S．极") == ["甲", "乙 N．极 S．极"]
    assert options("A、x") == [] and options("12 A, 13 B") == []


def test_same_as_scanner():
    rng = random.Random(3)
    pool = 'ab1 ,，、;"“”()（）「」|/\n'
    bodies = ["".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(3000)] + ["x," * 40000]
    flags = np.array([rng.random() < 0.3 for _ in bodies])
    for i, (b, got) in enumerate(zip(bodies, all_values(bodies, flags))):
        want = scan(b, bool(flags[i]))
        assert got == (want if len(want) > 1 else []), b
    part = pa.array(["", *bodies, None], pa.string()).slice(1, 40)  # a slice of a longer buffer
    assert split_rows(part, flags[:40])[0].to_pylist() == split_rows(pa.array(bodies[:40]), flags[:40])[0].to_pylist()


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, "points", "a,b", 9), (2, "stem", "a,b", 9), (3, "points", None, 9), (4, None, "c|d", 9), (1, "points", "e;f", 9), (5, "options", "A．p B．q", 9), (6, "answers", "", 9)],
        "raw_id long, slot string, body string, value int",
    )
    got = sorted((r.raw_id, r.pos, r.value) for r in unpack(df).collect())
    assert got == [(1, 1, "a"), (1, 1, "e"), (1, 2, "b"), (1, 2, "f"), (4, 1, "c"), (4, 2, "d"), (5, 1, "p"), (5, 2, "q")]
    assert unpack(df.limit(0)).collect() == []
