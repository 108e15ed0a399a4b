"""SET-04 and GRA-06 count pairs in parts whose size does not grow with the input."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from strandweave.operators import aggregates, tracks


def _rows(spark, n_keys, n_values):
    r = random.Random(3)
    rows = sorted({(r.randrange(n_keys), r.randrange(n_values)) for _ in range(6_000)})
    return rows, spark.createDataFrame([*rows, (1, None), (2, None)], "k long, v long")


def test_shared_sets_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "PAIRS_A_PART", 500, raising=False)
    rows, df = _rows(spark, 400, 300)
    by_value = {}
    for k, v in rows:
        by_value.setdefault(v, []).append(k)
    want = Counter(p for ks in by_value.values() for p in combinations(sorted(ks), 2))
    got = aggregates.shared_sets(df, "k", "v").withColumn("part", F.spark_partition_id()).collect()
    assert {(x.a, x.b): x.n_shared for x in got} == want and len(got) == len(want)
    assert max(Counter(x.part for x in got).values()) < 5 * 500


def test_no_pairs(spark):
    assert aggregates.shared_sets(spark.createDataFrame([], "k long, v long"), "k", "v").count() == 0


def test_merged_groups_equal_brute_force(spark):
    rows, df = _rows(spark, 60, 20_000)
    rows += [(k + 100, v) for k, v in rows if k < 10] + [(k + 200, v) for k, v in rows if k < 10 and v % 3]
    got = {x.group_id: x.merged_id for x in tracks.merged_groups(spark.createDataFrame(rows, "group_id long, member long")).collect()}
    sets = {k: {v for q, v in rows if q == k} for k in {k for k, _ in rows}}
    root = {k: k for k in sets}
    for _ in sets:
        for a, b in combinations(sets, 2):
            n = len(sets[a] & sets[b])
            if n > 0.5 * len(sets[a]) or n > 0.5 * len(sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_lists_are_cut_and_a_key_of_many_pairs_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "PAIRS_A_PART", 300)
    monkeypatch.setattr(aggregates, "LIST", 16)
    rows = [(k, 0) for k in range(200)] + [(0, v) for v in range(1, 40)] + [(k, v) for v in range(1, 40) for k in range(300, 330)]
    by_value = {}
    for k, v in rows:
        by_value.setdefault(v, []).append(k)
    want = Counter(p for ks in by_value.values() for p in combinations(sorted(ks), 2))
    df = spark.createDataFrame(rows, "k long, v long")
    made = aggregates.shared_sets(df, "k", "v")
    got = made.withColumn("part", F.spark_partition_id()).collect()
    assert {(x.a, x.b): x.n_shared for x in got} == want and len(got) == len(want)
    # key 0 meets 229 keys, 1369 times
    assert len({x.part for x in got if x.a == 0}) > 1
    # an a is sent once a value and piece of its list, not once a pair
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan.split("RepartitionByExpression")[0]
