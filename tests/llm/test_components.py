import random

from tillwright.llm.components import components


def test_equals_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 160)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (None, 3), (40, 39)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, root(x)) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
