"""Trees over wanted leaves and groups of paralogues against brute force."""

import random
from itertools import combinations

import pytest

from strandweave.operators import graph as G
from strandweave.operators import joins as J
from strandweave.adapters import Inputs
from strandweave.plans import registry


def plain_tree(up, wanted):
    """One leaf at a time, one step at a time."""
    on_way = set(wanted)
    for leaf in wanted:
        at = up.get(leaf)
        while at is not None:
            on_way.add(at)
            at = up.get(at)
    kids = {n: sum(up.get(c) == n for c in on_way) for n in on_way}
    kept = set(wanted) | {n for n in on_way if kids[n] > 1}
    out = set()
    for n in kept:
        at = up.get(n)
        while at is not None and at not in kept:
            at = up.get(at)
        out.add((n, at, n in wanted))
    return out


def rows_of(spark, up, wanted):
    tree = spark.createDataFrame([*up.items()], "node string, parent string")
    return {tuple(r) for r in G.species_tree(tree, spark.createDataFrame([(w,) for w in wanted], "node string")).collect()}


def test_species_tree_against_single_steps(spark):
    rnd = random.Random(6)
    for n in (1, 2, 12, 60):
        up = {f"n{i}": f"n{rnd.randrange(i)}" for i in range(1, n)}
        wanted = {f"n{i}" for i in range(n) if rnd.random() < 0.4} | {"n0" if n == 1 else f"n{n - 1}"}
        assert rows_of(spark, up, wanted) == plain_tree(up, wanted)


def test_species_tree_of_long_chains_and_odd_tables(spark):
    n = 10_000
    up = {f"a{i}": f"a{i + 1}" for i in range(n)} | {f"b{i}": f"b{i + 1}" for i in range(n)} | {f"b{n}": "a5000", f"a{n}": None}
    assert rows_of(spark, up, {"a0", "b0"}) == {("a0", "a5000", True), ("b0", "a5000", True), ("a5000", None, False)}
    assert rows_of(spark, {"x": None}, {"unknown"}) == {("unknown", None, True)} and rows_of(spark, {"x": "y"}, set()) == set()
    with pytest.raises(ValueError):
        rows_of(spark, {"a": "b", "b": "c", "c": "a"}, {"a"})


def plain_cliques(edges):
    nodes = sorted({x for e in edges for x in e})
    near = {frozenset(e) for e in edges if e[0] != e[1]}
    all_ = [set(c) for k in range(2, len(nodes) + 1) for c in combinations(nodes, k) if all(frozenset(p) in near for p in combinations(c, 2))]
    return sorted(sorted(c) for c in all_ if not any(c < d for d in all_))


def plain_groups(cliques):
    sets = [set(c) for c in sorted(cliques, key=lambda c: (-len(c), c))]
    while True:
        hit = next(((i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) / len(sets[i]) > 0.5 or len(sets[i] & sets[j]) / len(sets[j]) > 0.5), None)
        if hit is None:
            return [sorted(s) for s in sets]
        i, j = hit
        sets.append(sets[i] | sets[j])
        del sets[j], sets[i]


def test_cliques_and_groups_of_random_graphs(spark):
    rnd = random.Random(13)
    graphs = {g: sorted({tuple(sorted(rnd.sample(range(9), 2))) for _ in range(rnd.randrange(1, 26))}) for g in range(30)}
    rows = [(g, *(e if rnd.random() < 0.5 else e[::-1])) for g, edges in graphs.items() for e in edges]
    rows += [(0, 3, 3), (1, None, 2), rows[0]]
    edges = spark.createDataFrame(rows, "graph long, a long, b long")
    got = {}
    for r in G.maximal_cliques(edges).collect():
        got.setdefault(r.graph, []).append(r.clique)
    want = {g: plain_cliques(edges) for g, edges in graphs.items()}
    assert {g: sorted(c) for g, c in got.items()} == want
    groups = {}
    for r in G.paralogue_groups(edges).orderBy("group_no").collect():
        groups.setdefault(r.graph, []).append(r.members)
    assert groups == {g: plain_groups(c) for g, c in want.items()}
    limited = {(r.graph, r.problem) for r in G.paralogue_groups(edges, most_pairs=10, most_cliques=3).where("problem is not null").collect()}
    assert limited == {(g, "too many pairs") for g, e in graphs.items() if len(e) > 10} | {(g, "too many cliques") for g, e in graphs.items() if len(e) <= 10 and len(want[g]) > 3}
    assert G.paralogue_groups(edges.limit(0)).count() == 0


def test_a_hub_is_in_no_large_task(spark):
    edges = [(0, 0, i) for i in range(1, 3000)] + [(0, i, i + 1) for i in range(1, 2999, 2)]
    got = G.maximal_cliques(spark.createDataFrame(edges, "graph int, a long, b long")).collect()
    assert sorted(r.clique for r in got) == sorted([[0, i, i + 1] for i in range(1, 2999, 2)] + [[0, 2999]])


def test_registered_paralogue_groups(spark):
    sf = "/root/testdata/sf0.001"
    x = Inputs(spark, sf)
    graphs = {}
    for r in J.paralogue_pairs(x.x_hom, x.x_homtype, x.x_gene).collect():
        graphs.setdefault(r.species_id, []).append((r.first, r.second))
    got = {}
    for r in registry.queries()["GRA-06-cliques"](spark, sf).orderBy("group_no").collect():
        got.setdefault(r.graph, []).append(r.members)
    small = {g: e for g, e in graphs.items() if len({x for p in e for x in p}) <= 16}
    assert small and {g: got[g] for g in small} == {g: [",".join(map(str, m)) for m in plain_groups(plain_cliques(e))] for g, e in small.items()}
