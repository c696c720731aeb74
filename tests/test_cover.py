"""Directory covers against their definition, and tables of pushed queries."""

import random

import pytest

from weftline.functions import pushed
from weftline.operators import cover


def parts(path):
    root, rest = (path.split("://", 1)[0] + "://" + path.split("://", 1)[1].split("/", 1)[0], path.split("://", 1)[1].partition("/")[2]) if "://" in path else ("", path)
    return root, [x for x in rest.split("/") if x]


def joined(root, names):
    return "/".join([root, *names])


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_each_path_is_under_one_node(spark, most):
    rng, rows = random.Random(most), []
    for _ in range(120):
        depth = rng.randint(1, 4)
        rows.append((rng.choice([1, 2, None]), rng.choice(["s3://b", "hdfs://nn:1", ""]) + "/" + "/".join(rng.choice("abc") for _ in range(depth)) + rng.choice(["", "/"])))
    rows += [(3, None), (4, "s3://b"), (4, "s3://c/x")]
    got = [tuple(r) for r in cover.directory_cover(spark.createDataFrame(rows, "k int, path string"), ["k"], most=most).collect()]
    for k in (1, 2, None, 4):
        sets = {(parts(p)[0], tuple(parts(p)[1])) for x, p in rows if x == k and p is not None}
        mine = {node: n for x, node, n in got if x == k}
        under = {joined(r, n): [node for node in mine if joined(r, n) == node or joined(r, n).startswith(node + "/")] for r, n in sets}
        assert all(len(x) == 1 for x in under.values()) and sum(mine.values()) == len(sets)
        assert len(mine) <= max(most, len({r for r, _ in sets}))
        if most == 1000:
            assert all(n == 1 or (node in under) for node, n in mine.items())
    assert not [r for r in got if r[0] == 3]
    empty = spark.createDataFrame([], "k int, path string")
    assert cover.directory_cover(empty, ["k"]).collect() == []


def test_tables_of_pushed_queries(spark):
    cases = [
        (None, None), ("", []), ("select 1", []), ("select * from a, b", ["a"]), ("from a select b", ["a"]), ("select 'from x", ["x"]),
        ("select * from a -- join b", ["a"]), ("select * from /* from z */ A.b", ["A.b"]), ("with x as (select 1 from y) select * from X", ["y"]),
        ("select 'a\\' from q' from `a b`.c", ["ab.c"]), ('select "from q" from t JOIN u.v', ["t", "u.v"]),
    ]
    got = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(cases)], "i int, q string").select("i", pushed.tables(pushed.F.col("q")).alias("t")).collect()
    assert {r.i: r.t for r in got} == {i: t for i, (_, t) in enumerate(cases)}
