"""Taxonomy and covering graphs."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut


def ancestors(tree: DataFrame) -> DataFrame:
    """(node, ancestor, distance) for all ancestors of every node of a table (node, parent).

    Paths double in length each round, so a tree of depth d takes about log2(d) joins. A table with a cycle is no tree
    and raises ValueError.
    """
    paths = Cut(tree.where("parent is not null").select("node", F.col("parent").alias("ancestor"), F.lit(1).alias("distance")), "paths").df
    reach = 1
    while True:
        upper = paths.where(F.col("distance") <= reach).select(F.col("node").alias("ancestor"), F.col("ancestor").alias("far"), F.col("distance").alias("more"))
        longer = paths.where(F.col("distance") == reach).join(upper, "ancestor").select("node", F.col("far").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance"))
        longer = Cut(longer, "paths").df
        rows = longer.agg(F.count("*").alias("n"), F.count_if(F.col("node") == F.col("ancestor")).alias("loops")).first()
        if rows["loops"]:
            raise ValueError("a node is its own ancestor")
        if not rows["n"]:
            return paths
        paths = paths.unionByName(longer)
        reach *= 2


def leaves(tree: DataFrame) -> DataFrame:
    return tree.select("node").join(tree.select(F.col("parent").alias("node")), "node", "left_anti")


def subtree_leaves(tree: DataFrame) -> DataFrame:
    """(ancestor, n_leaves): leaves below each inner node."""
    return ancestors(tree).join(leaves(tree), "node", "left_semi").groupBy("ancestor").agg(F.count("*").alias("n_leaves"))


def by_tree_distance(tree: DataFrame, query: str) -> DataFrame:
    """(node, steps): leaves by the number of levels up to the ancestor they share with a query leaf, which comes first."""
    up = ancestors(tree)
    # the path from one node to the root: as many rows as the tree is deep
    own = up.where(F.col("node") == query).select("ancestor", F.col("distance").alias("steps"))
    shared = up.join(leaves(tree), "node", "left_semi").join(F.broadcast(own), "ancestor").groupBy("node").agg(F.min("steps").alias("steps"))
    return shared.withColumn("steps", F.when(F.col("node") == query, 0).otherwise(F.col("steps")))


def covering_roots(edges: DataFrame) -> DataFrame:
    """(exon_id, root): for every covered exon its least root, for roots -1; edges are (gene_id, master, covered).

    Roots are masters that nothing covers. Each exon carries the least root that reached it and hands it down only when
    it got a lesser one, so a round moves a row per exon at most and the work ends with the longest chain; nodes of a
    cycle without a root get none.
    """
    down = Cut(edges.select("master", "covered").distinct(), "covers")
    roots = down.df.select(F.col("master").alias("exon_id")).distinct().join(down.df.select(F.col("covered").alias("exon_id")), "exon_id", "left_anti")
    state = Cut(roots.select("exon_id", F.col("exon_id").alias("root"), F.lit(True).alias("fresh")), "roots")
    while not state.df.where("fresh").isEmpty():
        handed = state.df.where("fresh").join(down.df, F.col("exon_id") == F.col("master")).select(F.col("covered").alias("exon_id"), "root", F.lit(None).cast("long").alias("had"))
        both = state.df.select("exon_id", "root", F.col("root").alias("had")).unionByName(handed)
        least = both.groupBy("exon_id").agg(F.min("root").alias("root"), F.min("had").alias("had"))
        after = Cut(least.select("exon_id", "root", (F.col("had").isNull() | (F.col("root") < F.col("had"))).alias("fresh")), "roots")
        state.drop()
        state = after
    down.drop()
    return state.df.select("exon_id", F.when(F.col("root") == F.col("exon_id"), F.lit(-1).cast("long")).otherwise(F.col("root")).alias("root"))


def unrooted(edges: DataFrame) -> DataFrame:
    """(gene_id, exon_id): the exons of covering edges that no root reaches: those of a cycle, and what only they cover."""
    nodes = edges.select("gene_id", F.explode(F.array("master", "covered")).alias("exon_id")).distinct()
    return nodes.join(covering_roots(edges).select("exon_id"), "exon_id", "left_anti").select("gene_id", "exon_id")


def serialised(tree: DataFrame) -> DataFrame:
    """(node, text): nested parentheses of each node directly below the root, children in order of name, bottom-up."""
    depth = ancestors(tree).groupBy("node").agg(F.max("distance").alias("depth"))
    level = depth.agg(F.max("depth")).first()[0] or 0
    now = tree.join(depth, "node")
    text = now.where(F.col("depth") == level).select("node", "parent", F.col("node").alias("text"))
    for d in range(level, 1, -1):
        inner = text.groupBy("parent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "text"))), lambda x: x["text"]), ",").alias("inside")).withColumnRenamed("parent", "node")
        own = now.where(F.col("depth") == d - 1).select("node", "parent").join(inner, "node", "left")
        text = own.select("node", "parent", F.when(F.col("inside").isNull(), F.col("node")).otherwise(F.concat(F.lit("("), "inside", F.lit(")"), "node")).alias("text"))
    return text.select("node", "text")


#: Rounds of pointer jumping after which a table of pointers is known to have a cycle: paths double in each.
MOST_ROUNDS = 64


def species_tree(tree: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, parent, is_leaf): the tree over the ``wanted`` leaves (node) of a taxonomy (node, parent), with its parents set.

    Nodes on the way from a leaf to the root stay if two of their children are on such ways; inner nodes with one child
    are passed over, those with none are gone, and the root is the last node that stays, its parent being null. A wanted
    node that stands above others stays as a leaf of its own. Ways are marked and passed over by pointers that double
    their reach each round, so a chain of n nodes takes about log2(n) rounds of n rows. Wanted nodes that the taxonomy
    does not know are roots by themselves; a cycle raises ValueError.
    """
    up = Cut(tree.where("node is not null and parent is not null").select("node", "parent").distinct(), "tree-up")
    leaf = Cut(wanted.where("node is not null").select("node").distinct(), "tree-leaves")
    marked, jump = Cut(leaf.df, "tree-marked"), Cut(up.df, "tree-jump")
    for _ in range(MOST_ROUNDS):
        above = marked.df.join(jump.df, "node").select(F.col("parent").alias("node"))
        after = Cut(marked.df.unionByName(above).distinct(), "tree-marked")
        further = Cut(jump.df.join(jump.df.select(F.col("node").alias("parent"), F.col("parent").alias("far")), "parent").select("node", F.col("far").alias("parent")), "tree-jump")
        marked.drop()
        jump.drop()
        marked, jump = after, further
        if jump.df.isEmpty():
            break
    else:
        raise ValueError("the taxonomy has a cycle")
    inside = up.df.join(marked.df, "node", "left_semi")
    forks = inside.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n")).where("n > 1").select("node")
    kept = Cut(leaf.df.unionByName(forks).distinct(), "tree-kept")
    # nodes that stay end a pointer; the others hand on what they point to
    ends = kept.df.select(F.col("node").alias("at"), F.lit(True).alias("stop"))
    now = Cut(inside.select("node", F.col("parent").alias("at")).join(ends, "at", "left").select("node", "at", F.coalesce("stop", F.lit(False)).alias("stop")), "tree-pointers")
    while True:
        on = now.df.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("stop").alias("ends"))
        moving = now.df.where("not stop").join(on, "at").select("node", F.col("next").alias("at"), F.col("ends").alias("stop"))
        after = Cut(now.df.where("stop").unionByName(moving), "tree-pointers")
        now.drop()
        now = after
        if now.df.where("not stop").isEmpty():
            break
    out = kept.df.join(now.df.select("node", F.col("at").alias("parent")), "node", "left").join(leaf.df.withColumn("is_leaf", F.lit(True)), "node", "left")
    return Cut(out.select("node", "parent", F.coalesce("is_leaf", F.lit(False)).alias("is_leaf")), "species-tree").df


def maximal_cliques(edges: DataFrame) -> DataFrame:
    """(graph, clique): the maximal cliques of each graph of (graph, a, b), as sorted arrays of their nodes.

    Nodes are ordered by degree, so that each has at most sqrt(2m) neighbours behind it; one task gets a node and the
    edges among those. What it finds is a maximal clique unless a node before it is a neighbour of all members, which a
    join counts. Loops and null ends are ignored; nodes without an edge are in no clique.
    """
    graph, node = (edges.schema[c].dataType.simpleString() for c in ("graph", "a"))
    once = edges.where("a <> b").select("graph", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    degree = once.select("graph", F.explode(F.array("a", "b")).alias("n")).groupBy("graph", "n").agg(F.count("*").alias("d"))
    rank = lambda t: degree.select("graph", F.col("n").alias(t), F.col("d").alias(f"d{t}"))
    placed = once.join(rank("a"), ["graph", "a"]).join(rank("b"), ["graph", "b"])
    forward = F.struct("da", "a") < F.struct(F.col("db").alias("da"), F.col("b").alias("a"))
    out = Cut(placed.select("graph", F.when(forward, F.col("a")).otherwise(F.col("b")).alias("low"), F.when(forward, F.col("b")).otherwise(F.col("a")).alias("high")), "clique-edges").df
    far = out.select("graph", F.col("low").alias("u"), F.col("high").alias("v"))
    wedge = out.select("graph", "low", F.col("high").alias("u")).join(out.select("graph", "low", F.col("high").alias("v")), ["graph", "low"]).join(far, ["graph", "u", "v"])
    local = out.select("graph", "low", F.col("high").alias("u"), F.lit(None).cast(node).alias("v")).unionByName(wedge.select("graph", "low", "u", "v"))

    def work(key, rows: pd.DataFrame) -> pd.DataFrame:
        near: dict = {u: set() for u in rows["u"]}
        for u, v in rows.loc[rows["v"].notna(), ["u", "v"]].astype(rows["u"].dtype).itertuples(index=False):
            near[u].add(v)
            near[v].add(u)
        found, stack = [], [(set(), set(near), set())]
        while stack:
            clique, open_, closed = stack.pop()
            if not open_ and not closed:
                found.append(sorted([key[1], *clique]))
                continue
            pivot = max(open_ | closed, key=lambda x: len(near[x] & open_))
            for x in sorted(open_ - near[pivot]):
                stack.append((clique | {x}, open_ & near[x], closed & near[x]))
                open_, closed = open_ - {x}, closed | {x}
        return pd.DataFrame({"graph": pd.Series([key[0]] * len(found), dtype=rows["graph"].dtype), "low": pd.Series([key[1]] * len(found), dtype=rows["low"].dtype), "clique": pd.Series(found, dtype=object)})

    found = Cut(local.groupBy("graph", "low").applyInPandas(work, f"graph {graph}, low {node}, clique array<{node}>"), "cliques").df
    before = out.select("graph", F.col("high").alias("member"), F.col("low").alias("earlier"))
    member = found.select("graph", "clique", F.explode("clique").alias("member"))
    larger = member.join(before, ["graph", "member"]).where(~F.array_contains("clique", F.col("earlier"))).groupBy("graph", "clique", "earlier").agg(F.count("*").alias("n")).where(F.col("n") == F.size("clique"))
    return found.join(larger.select("graph", "clique").distinct(), ["graph", "clique"], "left_anti").select("graph", "clique")


def fused(cliques: list[list], share: float = 0.5) -> list[list]:
    """Sets merged until no two have more than a share of either in common: the first such pair in order, which moves to the end."""
    sets = [set(c) for c in cliques]
    again = True
    while again:
        again = False
        for i, j in combinations(range(len(sets)), 2):
            both = len(sets[i] & sets[j])
            if both > share * len(sets[i]) or both > share * len(sets[j]):
                sets = [s for k, s in enumerate(sets) if k not in (i, j)] + [sets[i] | sets[j]]
                again = True
                break
    return [sorted(s) for s in sets]


def paralogue_groups(pairs: DataFrame, share: float = 0.5, most_pairs: int = 10_000, most_cliques: int = 2_000) -> DataFrame:
    """(graph, group_no, members, problem): groups of the paralogue pairs (graph, a, b) of each graph.

    Groups are the maximal cliques, largest first, equal ones by their members, merged as ``fused`` does. A graph of
    more than ``most_pairs`` pairs or ``most_cliques`` cliques is skipped and has one row that says so in ``problem``;
    these limits also bound the work of one task, which merges the cliques of one graph.
    """
    kind = pairs.schema["graph"].dataType.simpleString()
    node = pairs.schema["a"].dataType.simpleString()
    once = Cut(pairs.where("a <> b").select("graph", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "paralogue-pairs").df
    big = once.groupBy("graph").agg(F.count("*").alias("n")).where(F.col("n") > most_pairs).select("graph")
    cliques = Cut(maximal_cliques(once.join(big, "graph", "left_anti")), "paralogue-cliques").df
    many = cliques.groupBy("graph").agg(F.count("*").alias("n")).where(F.col("n") > most_cliques).select("graph")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        groups = fused(sorted((list(c) for c in rows["clique"]), key=lambda c: (-len(c), c)), share)
        return pd.DataFrame({"graph": rows["graph"].iloc[0], "group_no": range(len(groups)), "members": pd.Series(groups, dtype=object), "problem": pd.Series([None] * len(groups), dtype=object)})

    schema = f"graph {kind}, group_no int, members array<{node}>, problem string"
    done = cliques.join(many, "graph", "left_anti").groupBy("graph").applyInPandas(merge, schema)
    skipped = big.withColumn("problem", F.lit("too many pairs")).unionByName(many.withColumn("problem", F.lit("too many cliques")))
    return done.unionByName(skipped.select("graph", F.lit(None).cast("int").alias("group_no"), F.lit(None).cast(f"array<{node}>").alias("members"), "problem"))
