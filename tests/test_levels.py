"""Creation levels against a walk from each entity down."""

import random

import pytest

from weftline.operators import levels

EDGES = "type_name string, qualified_name string, dep_type_name string, dep_qualified_name string"


def brute(names, needs):
    """Longest way down from each name; None on or behind a cycle."""
    out = dict.fromkeys(names)
    changed = True
    while changed:
        changed = False
        for name in names:
            below = [out[d] for d in needs.get(name, ()) if d in out]
            if out[name] is None and None not in below:
                out[name] = max(below, default=-1) + 1
                changed = True
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    names = [(rng.choice("ab"), str(i)) for i in range(25)]
    pairs = {(a, b) for i, a in enumerate(names) for b in rng.sample(names[:i], min(i, rng.randint(0, 2)))}
    pairs |= {(names[20], names[22]), (names[22], names[20]), (names[24], names[22])} | ({(names[3], names[3])} if seed == 2 else set())
    pairs.add((names[5], ("elsewhere", "x")))
    needs = {}
    for a, b in pairs:
        needs.setdefault(a, set()).add(b)
    rows = spark.createDataFrame([(*a, *b) for a, b in [*pairs, *pairs]], EDGES)
    entities = spark.createDataFrame([*names, *names], "type_name string, qualified_name string")
    found = levels.create_levels(entities, rows)
    want = brute(names, needs)
    got = {(r.type_name, r.qualified_name): r.level for r in found.collect()}
    assert got == want and None in want.values() and found.count() == len(names)
    assert {(r.type_name, r.qualified_name) for r in levels.unplaced(found).collect()} == {k for k, v in want.items() if v is None}


def test_no_entities(spark):
    assert levels.create_levels(spark.createDataFrame([], "type_name string, qualified_name string"), spark.createDataFrame([], EDGES)).collect() == []
