import random

from tripkiln.llm.components import connected_components


def test_random_graphs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    edges += [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(5, 5), (None, 7), (-3, 140)]
    root = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {tuple(r) for r in connected_components(df).collect()} == {(x, find(x)) for x in root}
    assert connected_components(df.limit(0)).count() == 0
