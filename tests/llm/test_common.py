import random

from quirework.llm.common import LEAST_TASKS, connected_components, small_side


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.comp for r in got} == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_small_side_is_unmarked_beyond_its_bound(spark):
    big = spark.range(50)
    plan = lambda most: big.join(small_side(spark.range(20), "x", most), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(20) and "broadcast" not in plan(19)


def test_few_edges_make_few_files_in_many_partitions(spark):
    edges = spark.createDataFrame([(i - i % 3, i) for i in range(900)], "u long, v long")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = connected_components(edges)
        files = got.inputFiles()
        assert sorted((r.node, r.comp) for r in got.collect()) == [(i, i - i % 3) for i in range(900)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files) <= LEAST_TASKS
