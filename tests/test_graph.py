from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskspark.operators import graph as gr
from riskspark.operators import learners as le


def brute(nodes, edges, hops):
    cur, out = dict(nodes), []
    for _ in range(hops):
        members, of = defaultdict(list), defaultdict(lambda: defaultdict(list))
        for txn, kind, entity in edges:
            members[kind, entity].append(cur[txn])
        mean = {k: sum(v) / len(v) for k, v in members.items()}
        for txn, kind, entity in edges:
            of[txn][kind].append(mean[kind, entity])
        cur = {i: sum(sum(v) / len(v) for v in of[i].values()) if i in of else 0.0 for i in cur}
        out.append(cur)
    return out


def graph(n):
    """Entity 'hub' of one kind has a third of all edges; node 0 has none."""
    nodes = [(i, float(i * i % 17)) for i in range(n)]
    edges = [(i, "card", "hub" if i % 3 else f"c{i % 40}") for i in range(1, n)] + [(i, "mail", f"m{i % 25}") for i in range(1, n, 2)] + [(i, "mail", f"m{i % 7}") for i in range(1, n, 5)]
    return nodes, edges


@pytest.mark.parametrize("share", [0.001, 0.1, 1.0])
def test_two_hops_equal_brute_force(spark, share):
    nodes, edges = graph(240)
    n, e = spark.createDataFrame(nodes, "id long, x double"), spark.createDataFrame(edges, "txn long, entity_type string, entity string")
    got = {r["id"]: (r["nb1_x"], r["nb2_x"]) for r in gr.khop_features(n, e, "id", ["x"], 2, share).collect()}
    one, two = brute(nodes, edges, 2)
    assert got.keys() == one.keys()
    for i, (a, b) in got.items():
        assert a == pytest.approx(one[i]) and b == pytest.approx(two[i])
    last = {r["id"]: r["x"] for r in gr.khop_mean(n, e, "id", ["x"], 2).collect()}
    assert last == pytest.approx(two)


def test_no_join_task_holds_the_hub(spark):
    """Edges that are joined by entity have no hub, so hashing deals them evenly."""
    _, edges = graph(6000)
    e = gr.split_hubs(spark.createDataFrame(edges, "txn long, entity_type string, entity string"), 0.05)
    hubs = e.where("hub").select("entity").distinct().collect()
    assert [r["entity"] for r in hubs] == ["hub"] and e.where("hub").count() > e.count() / 3
    plain = e.where("not hub").repartition(16, "entity_type", "entity").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = sorted(r["count"] for r in plain.collect())
    assert sizes[-1] < e.count() / 4


def test_neighbours_tell_what_the_node_does_not(spark):
    """The label is the group's, seen in a node's neighbours only; two hops carry it further."""
    nodes = [(i, float((i // 10) % 2) if i % 10 else 0.0, (i // 10) % 2, "train" if i < 300 else "test") for i in range(600)]
    edges = [(i, "group", f"g{i // 10}") for i in range(600)]
    n = spark.createDataFrame(nodes, "id long, x double, label int, mask string")
    x = n.join(gr.khop_features(n, spark.createDataFrame(edges, "txn long, entity_type string, entity string"), "id", ["x"], 2), "id").where("id % 10 = 0")
    _, pred = le.fit_and_score(x.where("mask = 'train'"), x.where("mask = 'test'"), ["x", "nb1_x", "nb2_x"], "label", "logistic")
    right = pred.agg(F.avg(((F.col("score") > 0.5) == (F.col("label") == 1)).cast("double"))).first()[0]
    assert right == 1.0
