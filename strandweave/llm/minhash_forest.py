"""Near-duplicate documents by a MinHash LSH forest: sorted signature orders with adaptive depth, verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.operators.components import connected_components
from strandweave.session import Cut

WORDS = 5
ORDERS, KEY, HASHES = 24, 8, 96
_RNG = np.random.default_rng(20240607)
_MIX = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_A = (_RNG.integers(1, 2**31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
#: Each order starts with four hashes of its own and goes on with four that other orders start with.
_ORDER = np.array([[*range(4 * t, 4 * t + 4), *((4 * t + 4 + 17 * j) % HASHES for j in range(4))] for t in range(ORDERS)])


class Shingler:
    """Hashed shingle sets of texts; word hashes met before are kept, at most ``limit`` of them."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's 5-word shingles; of a shorter word sequence as a whole, else none."""
        words = text.encode().lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.limit:
            self.known = {}
        try:
            own = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words):
                if word not in self.known:
                    self.known[word] = xxhash.xxh64_intdigest(word)
            own = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = len(words) - WORDS + 1
        if n < 1:
            mixed = (own * _MIX[: len(own)]).sum(keepdims=True) + np.uint64(len(own))
        else:
            mixed = own[:n] * _MIX[0]
            for k in range(1, WORDS):
                mixed += own[k : k + n] * _MIX[k]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def signature(hashes: np.ndarray, block: int = 4096) -> np.ndarray:
    """96 MinHash values of 16 bits."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = hashes.astype(np.uint32)
    for at in range(0, len(short), block):
        low = np.minimum(low, (np.multiply.outer(_A, short[at : at + block]) + _B[:, None]).min(axis=1))
    return ((low ^ (low >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint16)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_hash binary, sig binary, text_hash) of every whole text, one map."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler()
        for batch in batches:
            n, key, sig = [], [], []
            for at in range(0, batch.num_rows, 512):
                for text in batch.column(1).slice(at, 512).to_pylist():
                    found = own.hashes(text)
                    n.append(len(found))
                    key.append(xxhash.xxh128_digest(found.tobytes()) if len(found) else None)
                    sig.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary()), batch.column(2)], ["doc_id", "n_shingles", "set_hash", "sig", "text_hash"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_hash binary, sig binary, text_hash long")


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and order: the order's number, its sort key and the set's size."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            m = part.num_rows
            if not m:
                continue
            sig = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(m, HASHES)
            keys = sig[:, _ORDER].astype(">u2")  # big-endian, so that bytes sort as the values do
            flat = keys.reshape(m * ORDERS, KEY).tobytes()
            width = 2 * KEY
            key = pa.array([flat[i : i + width] for i in range(0, len(flat), width)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(ORDERS, dtype=np.int32), m)), key, pa.array(np.repeat(part.column(0).to_numpy(), ORDERS)), pa.array(np.repeat(part.column(1).to_numpy(), ORDERS))],
                ["tree", "key", "doc_id", "n_shingles"],
            )


def depths(shared: np.ndarray, depth: int, sparse: int) -> np.ndarray:
    """How long a prefix each row must share with a later one, from what it shares with its next 1, 2, ... rows (rows of ``shared``).

    In a sparse region it is the least depth, from ``sparse`` on, that fewer rows share than are looked at. A region of
    which more rows share ``depth`` values is dense; there it is the prefix shared with the nearest row.
    """
    return np.where(shared[-1] >= depth, np.maximum(shared[0], depth), np.maximum(shared[-1] + 1, sparse))


def _neighbours(depth: int, sparse: int, reach: int, percent: int):
    """Pairs of rows near one another in an order whose keys share a prefix, of the length that ``depths`` tells by region.

    A row is paired with its next ``reach`` rows; what dense regions leave out is compared by ``crowded``. The first and last ``reach`` rows of a task come out as well, with the hash
    of their prefix as ``spot``, for ``across_edges``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        head: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, KEY)
            own = (batch.column(0).to_numpy(), keys, batch.column(2).to_numpy(), batch.column(3).to_numpy())
            old = 0 if held is None else len(held[0])
            tree, keys, doc, n = own if held is None else tuple(np.concatenate(x) for x in zip(held, own, strict=True))
            size = len(tree)
            shared = np.zeros((reach, size), np.int8)
            for k in range(1, min(reach, size - 1) + 1):
                same = (keys[:-k] == keys[k:]) & (tree[:-k] == tree[k:])[:, None]
                shared[k - 1, :-k] = np.cumprod(same, axis=1, dtype=np.int8).sum(axis=1)
            least = depths(shared, depth, sparse)
            out_a, out_b = [], []
            for k in range(1, min(reach, size - 1) + 1):
                at = np.flatnonzero(shared[k - 1, :-k] >= least[:-k])
                at = at[at + k >= old]  # pairs inside what was held are out already
                a, b = at, at + k
                fit = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
                out_a.append(np.minimum(doc[a], doc[b])[fit]), out_b.append(np.maximum(doc[a], doc[b])[fit])
            if out_a:
                pairs = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], axis=1), axis=0)
                yield _pairs(pairs[:, 0], pairs[:, 1])
            if head is None or len(head[0]) < reach:
                grown = own if head is None else tuple(np.concatenate(x) for x in zip(head, own, strict=True))
                head = tuple(x[:reach] for x in grown)
            held = (tree[-reach:], keys[-reach:], doc[-reach:], n[-reach:])
        for tree, keys, doc, n in (head, held) if held is not None else ():
            spots = [xxhash.xxh64_intdigest(bytes([t]) + key.tobytes()) for t, key in zip(tree.tolist(), keys[:, :depth], strict=True)]
            yield _pairs(doc, n, np.array(spots, np.uint64).view(np.int64))

    return work


def _pairs(a: np.ndarray, b: np.ndarray, spot: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()) if spot is None else pa.array(spot)], ["a", "b", "spot"])


def across_edges(edges: DataFrame, reach: int, percent: int) -> DataFrame:
    """Pairs (a, b) among the first and last rows of all tasks, (a: doc_id, b: n_shingles, spot), that share a prefix.

    A prefix of at most ``reach`` documents lies wholly in these rows where it is cut by the edge of a range; one of
    more is left to ``crowded``, so no group is larger than ``reach``.
    """
    rows = edges.select("spot", "a", "b").distinct()
    few = rows.groupBy("spot").agg(F.count("*").alias("k")).where(F.col("k").between(2, reach)).select("spot")
    rows = rows.join(few, "spot")
    other = rows.select("spot", F.col("a").alias("x"), F.col("b").alias("y"))
    return rows.join(other, "spot").where((F.col("a") < F.col("x")) & (F.least("b", "y") * 100 >= F.greatest("b", "y") * percent)).select("a", F.col("x").alias("b"))


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles array<long>), sorted and distinct."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [own.hashes(text).view(np.int64) for text in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
                values = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "shingles"])

    return docs.mapInArrow(work, "doc_id long, shingles array<long>")


def one_text(rows: DataFrame) -> DataFrame:
    """(doc_id, text): of several texts of a doc_id the one of least hash."""
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def near_duplicates(docs: DataFrame, percent: int = 75, depth: int = 4, sparse: int = 3, reach: int = 6) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id, kept)``: documents linked where 100 * common >= percent * all shingles.

    Equal shingle sets are one class from the start, whatever its size. The class representatives stand in 24 sorted
    signature orders; neighbours with a long common prefix are candidates, so that a class or family of any size gives
    a number of candidates that grows with its members and is split over tasks by sort range. Every candidate is
    confirmed on the full sets (64-bit shingle hashes). Where more than ``reach`` documents share ``depth`` values, those
    not yet in one component go through an exact join on their rarest shingles (``crowded``); what stands on either side
    of a task's range is compared by ``across_edges``. So every pair that shares ``depth`` values at the head of one of
    the 24 orders is found, wherever ranges are cut: of pairs of similarity 0.75 all but 1 in 10,000. component_id is the least doc_id
    reachable. Null, empty and wordless texts have no shingles and stand alone; an empty table has no rows. doc_id is an
    integer and identifies a document; a repeated row comes out as often, and of rows that share a doc_id but not the
    text, each has the class of its own text, while the one of least hash is compared for the class that the doc_id leads.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = Cut(sketches(rows), "sketches")
    full = every.df.where("set_hash is not null")
    classes = Cut(full.groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = full.join(classes.df.select(F.col("rep").alias("doc_id"), "set_hash"), ["doc_id", "set_hash"]).groupBy("doc_id").agg(F.min_by(F.struct("n_shingles", "sig"), "text_hash").alias("s")).select("doc_id", "s.*")
    orders = Cut(firsts.mapInArrow(_tree_rows, "tree int, key binary, doc_id long, n_shingles long"), "orders")
    dealt = orders.df.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")
    near = Cut(dealt.mapInArrow(_neighbours(depth, sparse, reach, percent), "a long, b long, spot long"), "neighbours")
    pairs = Cut(near.df.where("spot is null").select("a", "b").unionByName(across_edges(near.df.where("spot is not null"), reach, percent)).distinct(), "candidates")
    near.drop()
    links = Cut(confirmed(rows, pairs.df, percent), "links")
    pairs.drop()
    groups = Cut(connected_components(links.df, "a", "b"), "groups").df
    more = crowded(rows, orders.df, groups, percent, depth, reach)
    orders.drop()
    if more is not None:
        wider = connected_components(more, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("wider"))
        every_node = groups.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(groups, "node", "left_anti").withColumn("component", F.col("node")))
        groups = every_node.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    out = (
        every.df.select("doc_id", "n_shingles", "set_hash")
        .join(classes.df, "set_hash", "left")
        .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def confirmed(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on their full shingle sets; only documents of some pair are read again.

    Both the named documents and the pairs grow with the corpus, so these joins are never broadcast.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().hint("merge")
    sets = Cut(_sets(one_text(rows.join(named, "doc_id", "left_semi"))), "sets").df
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(common * 100 >= union * percent).select("a", "b")


def crowded(rows: DataFrame, orders: DataFrame, groups: DataFrame, percent: int, depth: int, reach: int) -> DataFrame | None:
    """Edges (a, b) between components, of all links among the documents that share a prefix with more than ``reach`` others; None if there are none.

    ``groups`` (node, component) holds the components found so far. Documents of prefixes that more than one component
    has are joined on their rarest shingles: shingles stand in order of how many of these documents have them, and two
    sets with enough in common share one among the first of both (``rarest``). So a family that stays below the threshold
    meets in few pairs, however large it is, and one component's documents never meet each other.
    """
    spots = orders.select(F.xxhash64("tree", F.substring("key", 1, 2 * depth)).alias("spot"), "doc_id")
    dense = spots.groupBy("spot").agg(F.count("*").alias("n")).where(F.col("n") > reach).select("spot")
    inside = Cut(spots.join(dense.hint("merge"), "spot"), "crowds")
    of = Cut(inside.df.join(groups.select(F.col("node").alias("doc_id"), "component").hint("merge"), "doc_id", "left").select("spot", "doc_id", F.coalesce("component", "doc_id").alias("own")), "crowd-members")
    inside.drop()
    mixed = of.df.groupBy("spot").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo < hi").select("spot")
    named = Cut(of.df.join(mixed.hint("merge"), "spot").select("doc_id", "own").distinct(), "crowd-named")
    of.drop()
    if named.df.isEmpty():
        return None
    sets = Cut(_sets(one_text(rows.join(named.df.select("doc_id").hint("merge"), "doc_id", "left_semi"))), "crowd-sets")
    first = Cut(rarest(sets.df.join(named.df.hint("merge"), "doc_id"), percent), "crowd-rarest")
    pairs = Cut(_meeting(first.df, percent), "crowd-pairs")
    first.drop()
    left, right = (sets.df.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    linked = pairs.df.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(common * 100 >= union * percent)
    out = Cut(linked.select(F.least("own_a", "own_b").alias("a"), F.greatest("own_a", "own_b").alias("b")).distinct(), "crowd-links").df
    for table in (named, sets, pairs):
        table.drop()
    return out


def rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, doc_id, own, size, at, heads): the first shingles of each set (doc_id, shingles, own), the rarest first.

    Of two sets of which the smaller has m and the larger n shingles, ``common`` of them shared, 100 * common >= percent *
    (m + n - common) needs common >= percent * n / 100 and common >= 2 * percent * m / (100 + percent). So one shared
    shingle is among the first n - ceil(percent * n / 100) + 1 of the larger set, and among the first m - ceil(2 *
    percent * m / (100 + percent)) + 1 of the smaller; ``heads`` says whether a place is among the latter. Shingles that
    only one set has take their places and are left out.
    """
    tokens = sets.select("doc_id", "own", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    shared = tokens.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    kept = tokens.join(shared.hint("merge"), "shingle").groupBy("doc_id").agg(F.first("own").alias("own"), F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("order"))
    most = lambda share: (F.col("size") - F.ceil(share) + 1).cast("int")
    alone = F.col("size") - F.size("order")
    larger, smaller = most(F.col("size") * percent / 100), most(2 * percent * F.col("size") / (100 + percent))
    first = F.slice("order", 1, F.greatest(larger - alone, F.lit(0)))
    placed = kept.select("doc_id", "own", "size", alone.alias("alone"), smaller.alias("smaller"), F.posexplode(first).alias("k", "x"))
    at = F.col("alone") + F.col("k")
    return placed.select(F.col("x.shingle").alias("shingle"), "doc_id", "own", "size", at.alias("at"), (at < F.col("smaller")).alias("heads"))


def _meeting(first: DataFrame, percent: int) -> DataFrame:
    """(a, b, own_a, own_b): documents of two components, a the smaller set, that meet on a shingle and whose places there leave enough to share.

    What meets on a shingle first are units, the documents of one component of about one size that have it at about one
    place: only those of two components of which some sizes and places leave enough are taken apart to documents. So a
    component's own documents are never paired, nor a family's with those that share a little too little.
    """
    mixed = first.groupBy("shingle").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.bool_or("heads").alias("headed")).where("lo < hi and headed").select("shingle")
    # sizes of a unit differ by less than one in forty, places by less than that share of the size
    about, deep = F.floor(40 * F.log("size")).cast("int"), F.floor(40 * F.col("at") / F.col("size")).cast("int")
    kept = Cut(first.join(mixed.hint("merge"), "shingle").withColumns({"about": about, "deep": deep}), "crowd-kept").df
    heads = kept.where("heads")
    key = ["shingle", "own", "about", "deep"]
    named = lambda df, t: df.select("shingle", *(F.col(c).alias(f"{c}_{t}") for c in df.columns if c != "shingle"))
    units = lambda df, t: named(df.groupBy(*key).agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.max(F.col("size") - F.col("at")).alias("most")), t)
    # what two sets can still share from their first shared shingle on, against what they must share
    enough = lambda most, m, n: most * (100 + percent) >= percent * (F.col(m) + F.col(n))
    possible = (F.col("own_a") != F.col("own_b")) & (F.col("lo_a") <= F.col("hi_b")) & (F.col("hi_a") * 100 >= F.col("lo_b") * percent) & enough(F.least("most_a", "most_b"), "lo_a", "lo_b")
    meet = units(heads, "a").join(units(kept, "b").hint("merge"), "shingle").where(possible).select("shingle", *(f"{c}_{t}" for t in "ab" for c in key[1:]))
    documents = lambda df, t: named(df.select(*key, F.col("doc_id").alias("doc"), "size", "at"), t)
    pairs = meet.join(documents(heads, "a").hint("merge"), ["shingle", *(f"{c}_a" for c in key[1:])]).join(documents(kept, "b").hint("merge"), ["shingle", *(f"{c}_b" for c in key[1:])])
    order = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("doc_a") < F.col("doc_b")))
    fit = F.col("size_a") * 100 >= F.col("size_b") * percent
    most = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    return pairs.where(order & fit & enough(most, "size_a", "size_b")).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"), "own_a", "own_b").distinct()
