"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.operators.components import connected_components
from strandweave.session import Cut

POOL, DEGREE, ALPHA, STARTS, BATCH = 32, 16, 1.2, 8, 256


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Walker:
    """Walks over the graph of one shard; similarities are computed for the visited vectors only and counted in ``evaluations``."""

    def __init__(self, x: np.ndarray, graph: np.ndarray):
        self.x, self.graph, self.evaluations = x, graph, 0

    def sims(self, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        self.evaluations += len(q)
        steps = range(0, len(q), 200_000)
        return np.concatenate([np.einsum("ij,ij->i", self.x[q[i : i + 200_000]], self.x[v[i : i + 200_000]]) for i in steps]) if len(q) else np.zeros(0, self.x.dtype)

    def greedy(self, queries: np.ndarray, starts: np.ndarray, width: int = POOL, least: float = 3.0) -> tuple[np.ndarray, np.ndarray, list]:
        """(nearest, seen, hits): the ``width`` nearest vectors that a best-first walk from ``starts`` meets, and all (query, vector) it meets in range."""
        n, m = len(self.x), len(queries)
        seen = np.zeros((m, n), bool)
        near = np.full((m, width), -1, np.int64)
        value = np.full((m, width), -3.0, self.x.dtype)
        closed = np.ones((m, width), bool)
        rows, hits = np.arange(m), []
        fresh = np.broadcast_to(starts, (m, len(starts)))
        while len(rows):
            new = (fresh >= 0) & ~seen[rows[:, None], np.maximum(fresh, 0)]
            at, slot = np.nonzero(new)
            found = np.full(fresh.shape, -3.0, self.x.dtype)
            found[at, slot] = self.sims(queries[rows[at]], fresh[at, slot])
            seen[rows[at], fresh[at, slot]] = True
            ok = found[at, slot] >= least
            hits.append((rows[at[ok]], fresh[at[ok], slot[ok]]))
            ids = np.hstack([near[rows], np.where(new, fresh, -1)])
            score = np.hstack([value[rows], found])
            shut = np.hstack([closed[rows], ~new])
            top = np.argpartition(-score, width - 1, axis=1)[:, :width]
            near[rows], value[rows], closed[rows] = (np.take_along_axis(a, top, 1) for a in (ids, score, shut))
            rows = rows[~closed[rows].all(axis=1)]
            pick = np.where(closed[rows], -4, value[rows]).argmax(axis=1)
            closed[rows, pick] = True
            fresh = self.graph[near[rows, pick]]
        return near, seen, hits

    def in_range(self, queries: np.ndarray, starts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs within range: the greedy walk, then along all neighbours of whatever lies in range."""
        _, seen, hits = self.greedy(queries, starts, least=least)
        n = len(self.x)
        q, v = (np.concatenate([h[i] for h in hits]) for i in (0, 1))
        all_q, all_v = [q], [v]
        while len(q):
            key = (q[:, None] * n + self.graph[v])[self.graph[v] >= 0]
            key = np.unique(key)
            key = key[~seen.ravel()[key]]
            seen.ravel()[key] = True
            q, v = key // n, key % n
            ok = self.sims(queries[q], v) >= least
            q, v = q[ok], v[ok]
            all_q.append(q)
            all_v.append(v)
        found, others = queries[np.concatenate(all_q)], np.concatenate(all_v)
        return found[found != others], others[found != others]


def prune(walker: Walker, rows: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust-pruned neighbours, (len(rows), degree): the nearest of the pool is kept and every other one dropped that lies
    alpha times nearer to it than to the vector itself, and so on. The first half of the places is given with alpha 1, so
    that a dense group does not take all of them and stays in touch with the rest."""
    out = np.full((len(rows), degree), -1, np.int64)
    at, slot = np.nonzero(pool >= 0)
    far = np.full(pool.shape, np.inf)
    far[at, slot] = np.maximum(1 - walker.sims(rows[at], pool[at, slot]), 0)
    alive = (pool >= 0) & (pool != rows[:, None])
    spare = np.zeros_like(alive)
    for k in range(degree):
        if k == degree // 2:
            alive |= spare
        some = np.flatnonzero(alive.any(axis=1))
        if not len(some):
            continue
        first = np.where(alive[some], far[some], np.inf).argmin(axis=1)
        pick = pool[some, first]
        out[some, k] = pick
        alive[some, first] = False
        again = pool[some] == pick[:, None]
        alive[some] &= ~again
        spare[some] &= ~again
        at, slot = np.nonzero(alive[some])
        between = np.maximum(1 - walker.sims(pick[at], pool[some[at], slot]), 0)
        drop = (1.0 if k < degree // 2 else alpha) * between <= far[some[at], slot]
        alive[some[at[drop]], slot[drop]] = False
        spare[some[at[drop]], slot[drop]] = k < degree // 2
    return np.take_along_axis(out, np.argsort(out < 0, axis=1, kind="stable"), 1)


def build_graph(x: np.ndarray, pool: int = POOL, degree: int = DEGREE, alpha: float = ALPHA) -> Walker:
    """The robust-pruned graph of a shard, up to 2 * degree neighbours a vector (-1 where fewer).

    Vectors enter in batches of fixed size, the medoids first and the rest in an order that does not depend on their ids:
    each walks the graph so far from the medoids, its pool is what the walk meets, the medoids and the nearest of its own
    batch, and its kept neighbours get an edge back; lists that overflow are pruned again. The work for a vector does
    not grow with the shard beyond the length of its walk.
    """
    n = len(x)
    graph = np.full((n, 2 * degree), -1, np.int64)
    filled = np.zeros(n, np.int64)
    walker = Walker(x, graph)
    starts = medoids(x)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    for begin in range(0, n, BATCH):
        rows = order[begin : begin + BATCH]
        mates = x[rows] @ x[rows].T
        walker.evaluations += mates.size
        np.fill_diagonal(mates, -3)
        top = np.argsort(-mates, axis=1, kind="stable")[:, : min(degree, len(rows) - 1)]
        pools = [rows[top], np.broadcast_to(starts, (len(rows), len(starts)))]
        if begin:
            pools.append(walker.greedy(rows, starts, pool)[0])
        kept = prune(walker, rows, np.hstack(pools), degree, alpha)
        graph[rows, :degree] = kept
        filled[rows] = (kept >= 0).sum(axis=1)
        src, slot = np.nonzero(kept >= 0)
        new, to = rows[src], kept[src, slot]
        unknown = ~(graph[to] == new[:, None]).any(axis=1)
        by = np.argsort(to[unknown], kind="stable")
        new, to = new[unknown][by], to[unknown][by]
        place = filled[to] + np.arange(len(to)) - np.searchsorted(to, to)
        own, most = np.unique(to), int(place.max(initial=0)) + 1
        wide = np.full((len(own), max(most, 2 * degree)), -1, np.int64)
        wide[:, : 2 * degree] = graph[own]
        wide[np.searchsorted(own, to), place] = new
        full = (wide >= 0).sum(axis=1) > 2 * degree
        graph[own[~full]] = wide[~full, : 2 * degree]
        graph[own[full]] = -1
        graph[own[full], :degree] = prune(walker, own[full], wide[full], degree, alpha)
        filled[own] = (graph[own] >= 0).sum(axis=1)
    return walker


def medoids(x: np.ndarray, count: int = STARTS, rounds: int = 3) -> np.ndarray:
    """Central vectors of a shard: a few rounds of k-means from evenly spaced rows, then the vector nearest each mean."""
    count = min(count, len(x))
    means = x[np.linspace(0, len(x) - 1, count).astype(int)]
    for _ in range(rounds):
        own = (x @ means.T).argmax(axis=1)
        means = np.array([x[own == k].mean(axis=0) if (own == k).any() else means[k] for k in range(count)])
    return np.unique((x @ means.T).argmax(axis=0))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links connect: each vector with the first of its component."""
    low = np.arange(n)
    while len(a):
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            break
    rest = np.flatnonzero(low != np.arange(n))
    return low[rest], rest


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding array<double>): rows that can link: a label, and finite components that are not all 0."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return wide.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda v: v != 0.0))


def choose_centres(classes: DataFrame, per_shard: int, most: int) -> dict:
    """{(label, dimensions): centres} from at most ``most`` vectors, those of smallest hash, drawn in proportion to the labels."""
    total = classes.count()
    share = min(1.0, min(most, max(1, total // per_shard)) / max(total, 1))
    keyed = classes.withColumn("h", F.xxhash64("rep", F.lit("centre"))).where(F.col("h") < F.lit(int(-(2**63) + share * 1.5 * 2**64)) if share * 1.5 < 1 else F.lit(True))
    rows = keyed.orderBy("h", "rep").limit(most).select("label", "embedding").collect()
    groups: dict = {}
    for r in rows:
        groups.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    return {k: unit(np.array(v)) for k, v in groups.items()}


def near_vectors(vectors: DataFrame, least: float = 0.98, overlap: int = 2, per_shard: int = 1000, block: int = 6000, most_centres: int = 4096, target_recall: float = 0.95) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``: vectors of equal label linked where their cosine is >= ``least``.

    Equal vectors of a label are one class from the start. Centres, a bounded sample (``most_centres``), cut each label
    into shards; every class belongs to the ``overlap`` nearest. A shard above ``block`` members is cut again around
    centres of its own until none is, so no task grows with the data. Each shard gets a robust-pruned graph, the
    adjacency lists of a class are united over its shards, and each class walks from the medoids of its shards along the
    united lists; from what it finds in range on, edges into other shards are followed by joins until nothing new is in
    range. Links are decided in double precision; one that several shards find counts once. The recall of
    n_links, in sum and as the mean over vectors, is audited against brute force over at most 500 vectors; where it falls
    short, the work is repeated with twice the overlap, and at last with all pairs of a label compared, in blocks.

    Vectors that are null, zero or hold null or non-finite components, and those without a label, have no links and are
    components of their own. Vectors of different lengths link with nothing. A repeated vec_id gives one row per row of
    the input; equal repeats link with each other, and all rows of an id bear its most links and its least component. An empty table gives an
    empty one. Other columns of the input, whatever their names, are not read.
    """
    good = Cut(valid_vectors(vectors), "vectors").df
    classes = Cut(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vector-classes").df
    for more in (1, 2, 4):
        counts, edges = _linked(classes, least, overlap * more, per_shard, block, most_centres)
        if audit_recall(classes, counts, least) >= target_recall:
            break
    else:
        counts, edges = _all_pairs(classes, least)
    groups = connected_components(edges, "a", "b")
    members = (
        good.join(classes.select("label", "embedding", "rep", "weight"), ["label", "embedding"])
        .join(counts.select(F.col("vec_id").alias("rep"), "links"), "rep", "left")
        .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select(F.col("vec_id").alias("of"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    members = members.groupBy("of").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    out = every.join(members, F.col("vec_id") == F.col("of"), "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _nearest(x: np.ndarray, centres: np.ndarray, overlap: int) -> list[list[int]]:
    k = min(overlap, len(centres))
    return np.sort(np.argpartition(-(x @ centres.T), k - 1, axis=1)[:, :k], axis=1).tolist()


def place(classes: DataFrame, overlap: int, per_shard: int, block: int, most_centres: int) -> DataFrame:
    """(rep, embedding, shard): every class in the shards of its nearest centres, none of them above ``block`` members."""
    if block < 3 * overlap:
        raise ValueError("shards of that size cannot be cut with so much overlap")
    centres = classes.sparkSession.sparkContext.broadcast(choose_centres(classes, per_shard, most_centres))
    schema = "rep long, embedding array<double>, shard string"

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (label, size), at in pdf.groupby([pdf.label, pdf.embedding.map(len)]).indices.items():
                own = centres.value.get((label, size))
                part = pdf.iloc[at][["rep", "embedding"]]
                found = [[0]] * len(at) if own is None else _nearest(unit(np.stack(part.embedding.to_numpy())), own, overlap)
                yield part.assign(shard=[[f"{label}/{size}/{j}" for j in row] for row in found]).explode("shard")

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf.centre].sort_values("rep")
        part = pdf.loc[~pdf.centre, ["rep", "embedding", "shard"]]
        if not len(own) or not len(part):
            return part
        found = _nearest(unit(np.stack(part.embedding.to_numpy())), unit(np.stack(own.embedding.to_numpy())), overlap)
        return part.assign(shard=[[f"{s}/{j}" for j in row] for s, row in zip(part.shard, found, strict=True)]).explode("shard")

    cut, level = Cut(classes.select("label", "rep", "embedding").mapInPandas(assign, schema), "shards"), 0
    while True:
        sizes = cut.df.groupBy("shard").agg(F.count("*").alias("size"))
        large = sizes.where(F.col("size") > block)
        if large.isEmpty():
            return cut.df
        level += 1
        # about as many centres as make shards of per_shard, from 4 * overlap to most_centres; another draw each round
        wanted = F.least(F.lit(most_centres), F.greatest(F.lit(4 * overlap), F.ceil(F.col("size") / per_shard)))
        members = cut.df.join(large, "shard").withColumn("buckets", F.ceil(F.col("size") / block).cast("int"))
        chosen = F.pmod(F.xxhash64("rep", F.lit(level)), F.ceil(F.col("size") / wanted)) == 0
        own = members.where(chosen).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).withColumn("centre", F.lit(True))
        members = members.withColumn("bucket", F.pmod(F.xxhash64("rep", F.lit("bucket")), "buckets").cast("int")).withColumn("centre", F.lit(False))
        both = members.unionByName(own).select("shard", "bucket", "centre", "rep", "embedding")
        split = both.groupBy("shard", "bucket").applyInPandas(divide, schema)
        after = Cut(cut.df.join(large, "shard", "left_anti").select("rep", "embedding", "shard").unionByName(split), "shards")
        cut.drop()
        cut = after


def _ends(ids: np.ndarray, lists: pd.Series) -> np.ndarray:
    """The united lists as places in ``ids`` (sorted), without the vectors of other shards; -1 fills up."""
    size = lists.map(len).to_numpy()
    flat = np.concatenate(lists.to_list()) if size.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(ids)), size)
    at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
    row, at = row[ids[at] == flat], at[ids[at] == flat]
    slot = np.arange(len(row)) - np.searchsorted(row, row)
    out = np.full((len(ids), max(1, int(slot.max(initial=0)) + 1)), -1, np.int64)
    out[row, slot] = at
    return out


def _exact(x: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose cosine in double precision is in range."""
    keep = [np.einsum("ij,ij->i", x[a[i : i + 200_000]], x[b[i : i + 200_000]]) >= least for i in range(0, len(a), 200_000)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return a[keep], b[keep]


def _rows(ids: np.ndarray, a: np.ndarray, b: np.ndarray, cost: int) -> pd.DataFrame:
    """One row per vector: the vectors linked with it, edges that connect its component, and its share of the comparisons."""
    n = len(ids)
    order = np.argsort(a, kind="stable")
    linked = np.split(ids[b[order]], np.searchsorted(a[order], np.arange(1, n)))
    roots, leaves = forest(n, a, b)
    order = np.argsort(roots, kind="stable")
    edges = np.split(ids[leaves[order]], np.searchsorted(roots[order], np.arange(1, n)))
    return pd.DataFrame({"vec_id": ids, "linked": linked, "edges": edges, "cost": np.full(n, cost / n)})


FOUND = "vec_id long, linked array<long>, edges array<long>, cost double"


def _counts(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    weights = classes.select(F.col("rep").alias("other"), "weight")
    return Cut(pairs.join(weights, "other").groupBy("vec_id").agg(F.sum("weight").alias("links")), "vector-counts").df


def search_shards(placed: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(found, united lists): what each class finds within its shards, as FOUND, and ``(rep, near)``."""

    def adjacency(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        ids = pdf.rep.to_numpy()
        graph = build_graph(unit(np.stack(pdf.embedding.to_numpy())).astype(np.float32)).graph
        return pd.DataFrame({"rep": ids, "near": [ids[g[g >= 0]] for g in graph]})

    lists = placed.groupBy("shard").applyInPandas(adjacency, "rep long, near array<long>")
    united = Cut(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency").df

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        ids, x = pdf.rep.to_numpy(), unit(np.stack(pdf.embedding.to_numpy()))
        walker = Walker(x.astype(np.float32), _ends(ids, pdf.near))
        starts = medoids(walker.x)
        hits = [walker.in_range(np.arange(i, min(i + 1024, len(ids))), starts, least - 1e-5) for i in range(0, len(ids), 1024)]
        a, b = _exact(x, np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits]), least)
        both = np.unique(np.concatenate([a * len(ids) + b, b * len(ids) + a]))
        return _rows(ids, both // len(ids), both % len(ids), walker.evaluations)

    return Cut(placed.join(united, "rep").groupBy("shard").applyInPandas(search, FOUND), "vector-links").df, united


def _linked(classes: DataFrame, least: float, overlap: int, per_shard: int, block: int, most_centres: int) -> tuple[DataFrame, DataFrame]:
    """((vec_id, links), (a, b)): linked weight of each class and edges that connect its component."""
    placed = place(classes, overlap, per_shard, block, most_centres)
    found, united = search_shards(placed, least)
    pairs = Cut(found.select("vec_id", F.explode("linked").alias("other")).distinct(), "vector-pairs").df
    edges = found.select(F.col("vec_id").alias("a"), F.explode("edges").alias("b"))
    shards = Cut(placed.groupBy("rep").agg(F.collect_set("shard").alias("shards")), "vector-shards").df
    steps = united.select(F.col("rep").alias("other"), F.explode("near").alias("next"))
    steps = steps.join(shards.select(F.col("rep").alias("next"), F.col("shards").alias("next_shards")), "next")
    own = classes.select(F.col("rep").alias("vec_id"), F.col("embedding").alias("x"))
    their = classes.select(F.col("rep").alias("next"), F.col("embedding").alias("y"))
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    front = pairs
    while True:
        # edges that leave the shards of a vector, from what it has in range
        out = front.join(shards.withColumnRenamed("rep", "vec_id"), "vec_id").join(steps, "other").where("vec_id <> next").where(~F.arrays_overlap("shards", "next_shards"))
        new = out.select("vec_id", "next").distinct().join(pairs.withColumnRenamed("other", "next"), ["vec_id", "next"], "left_anti")
        near = new.join(own, "vec_id").join(their, "next").where(dot("x", "y") / F.sqrt(dot("x", "x")) / F.sqrt(dot("y", "y")) >= least)
        sides = F.explode(F.array(F.struct("vec_id", F.col("next").alias("other")), F.struct(F.col("next").alias("vec_id"), F.col("vec_id").alias("other"))))
        front = Cut(near.select(sides.alias("p")).select("p.*").distinct(), "vector-pairs").df
        if front.isEmpty():
            return _counts(classes, pairs), edges
        pairs = pairs.unionByName(front)
        edges = edges.unionByName(front.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))


def _all_pairs(classes: DataFrame, least: float, block: int = 1500) -> tuple[DataFrame, DataFrame]:
    """As ``_linked``, from all pairs of a label: its classes in parts, two parts a task; the last resort where the audit fails."""
    keyed = classes.select("rep", "embedding", F.concat_ws("/", "label", F.size("embedding")).alias("shard"))
    sizes = keyed.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    blocks = keyed.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = blocks.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).select("shard", "low", "high", "part", "rep", "embedding")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        ids, x = pdf.rep.to_numpy(), unit(np.stack(pdf.embedding.to_numpy()))
        part = pdf.part.to_numpy()
        # a pair inside one part is decided in that part's own block
        hit = (x @ x.T >= least - 1e-5) & ((part[:, None] != part[None, :]) | (pdf.low.iloc[0] == pdf.high.iloc[0])) & ~np.eye(len(ids), dtype=bool)
        a, b = _exact(x, *np.nonzero(hit), least)
        return _rows(ids, a, b, len(ids) ** 2)

    found = Cut(blocks.groupBy("shard", "low", "high").applyInPandas(compare, FOUND), "vector-links").df
    pairs = found.select("vec_id", F.explode("linked").alias("other")).distinct()
    return _counts(classes, pairs), found.select(F.col("vec_id").alias("a"), F.explode("edges").alias("b"))


def audit_recall(classes: DataFrame, counts: DataFrame, least: float, sample: int = 500) -> float:
    """Links found / links there are, in sum or as the mean over vectors, whichever is less, of the ``sample`` classes of smallest hash against all classes, in blocks."""
    rows = classes.orderBy(F.xxhash64("rep", F.lit("audit")), "rep").limit(sample).select("rep", "label", "embedding").collect()
    if not rows:
        return 1.0
    queries: dict = {}
    for r in rows:
        queries.setdefault((r["label"], len(r["embedding"])), []).append(r)
    spark = classes.sparkSession
    asked = spark.sparkContext.broadcast({k: (np.array([r["rep"] for r in v]), unit(np.array([r["embedding"] for r in v]))) for k, v in queries.items()})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (label, size), at in pdf.groupby([pdf.label, pdf.embedding.map(len)]).indices.items():
                if (label, size) not in asked.value:
                    continue
                ids, q = asked.value[label, size]
                near = q @ unit(np.stack(pdf.embedding.to_numpy()[at])).T >= least
                near &= ids[:, None] != pdf.rep.to_numpy()[at][None, :]
                yield pd.DataFrame({"vec_id": ids, "truth": (near * pdf.weight.to_numpy()[at][None, :]).sum(axis=1)})

    truth = classes.mapInPandas(work, "vec_id long, truth long").groupBy("vec_id").agg(F.sum("truth").alias("truth"))
    found = F.least(F.coalesce("links", F.lit(0)), "truth")
    got = truth.where("truth > 0").join(counts, "vec_id", "left").agg(F.sum("truth").alias("t"), F.sum(found).alias("g"), F.avg(found / F.col("truth")).alias("each")).first()
    return min((got["g"] or 0) / got["t"], got["each"]) if got["t"] else 1.0
