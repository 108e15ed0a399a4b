"""Lookups, exon rules and similarity joins built on plain equi joins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.session import Cut, spread


def on_region(genes: DataFrame, regions: DataFrame, name: str) -> DataFrame:
    """Genes on the region of one name."""
    return genes.join(regions.where(F.col("region_name") == name), "region_id", "left_semi")


def by_synonym_or_description(wanted: DataFrame, synonyms: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(name, gene_id): the gene of a synonym, else the first gene whose symbol equals the name."""
    first = descriptions.groupBy("name").agg(F.min("gene_id").alias("second"))
    return wanted.join(synonyms, "name", "left").join(first, "name", "left").select("name", F.coalesce("gene_id", "second").alias("gene_id"))


def update_from(base: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` set anew from matching rows of another table, null where none matches."""
    return base.drop(column).join(other.select(key, column), key, "left")


def maps_of_genes(exons: DataFrame, maps: DataFrame) -> DataFrame:
    return exons.select("gene_id", "exon_id").join(maps, "exon_id")


def reverse_maps(maps: DataFrame) -> DataFrame:
    """(exon_id, cognate_exon_id): the reference exon of each mapped exon, the best by similarity, then the least."""
    w = Window.partitionBy("cognate_exon_id").orderBy(F.desc("similarity"), "exon_id", "part")
    return maps.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(F.col("cognate_exon_id").alias("exon_id"), F.col("exon_id").alias("reference_exon_id"))


def assembled_cdna(exons: DataFrame) -> DataFrame:
    """(gene_id, cdna): the slices of coding exons in order of start; genes with exons on both strands are left out."""
    from strandweave.functions.sequence import reverse_complement

    items = F.array_sort(F.collect_list(F.struct("start_in_gene", "exon_id", "dna")))
    own = exons.groupBy("gene_id").agg(items.alias("o"), F.min("strand").alias("lo"), F.max("strand").alias("hi")).where("lo = hi")
    forward = F.array_join(F.transform("o", lambda x: x["dna"]), "")
    return own.select("gene_id", F.when(F.col("lo") < 0, reverse_complement(forward)).otherwise(forward).alias("cdna"))


def coverage(rows: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """One row (total, without_hit)."""
    return rows.join(hits.select(key, F.lit(1).alias("hit")), key, "left").agg(F.count("*").alias("total"), F.count_if(F.col("hit").isNull()).alias("without_hit"))


def self_maps(exons: DataFrame) -> DataFrame:
    """Each exon mapped to itself: similarity 1 and one run of its length."""
    n = F.col("end_in_gene") - F.col("start_in_gene") + 1
    return exons.select("exon_id", F.col("exon_id").alias("cognate_exon_id"), F.lit(1.0).alias("similarity"), F.concat(n.cast("string"), F.lit("M")).alias("cigar"))


def class_by_ancestor(paths: DataFrame, inside: str, outside: str) -> DataFrame:
    """(node, is_inside): whether the nearest ancestor with one of two marks in its name has the first."""
    marked = paths.where(F.contains("ancestor", F.lit(inside)) | F.contains("ancestor", F.lit(outside)))
    nearest = marked.groupBy("node").agg(F.min_by(F.contains("ancestor", F.lit(inside)), "distance").alias("is_inside"))
    return paths.select("node").distinct().join(nearest, "node", "left").select("node", F.coalesce("is_inside", F.lit(False)).alias("is_inside"))


#: Letters hashed at once, and k-mers of a part in which those of all sequences meet.
LETTERS, GRAMS = 1 << 17, 1 << 21
#: Odd numbers that mix a hash's bits.
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every stretch of ``size`` letters, put together from those of 1, 2, 4, ... letters."""
    power = codes.astype(np.uint64) + np.uint64(1)
    out, done, doubled = np.zeros(len(codes), np.uint64), 0, 1
    while True:
        if size & doubled:
            out = out[: len(codes) - doubled - done + 1] * _power(MIX[0], doubled) + power[done : len(codes) - doubled + 1]
            done += doubled
        if 2 * doubled > size:
            break
        power = power[: len(power) - doubled] * _power(MIX[0], doubled) + power[doubled:]
        doubled *= 2
    for shift, factor in ((30, MIX[1]), (27, MIX[2])):
        out = (out ^ (out >> np.uint64(shift))) * factor
    return out ^ (out >> np.uint64(31))


def gram_hashes(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct k-mer of each text, sorted by hash; a shorter text is one k-mer itself.

    Equal k-mers have equal hashes; different ones seldom do.
    """
    padded = [s if len(s) >= size else s + "\0" * (size - len(s)) for s in texts]
    counts = np.array([len(s) - size + 1 for s in padded], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    # the stretches that begin in one text and end in another are left out
    own = _hashes(_codes("".join(padded)), size)[np.arange(len(owner)) + owner * (size - 1)]
    order = np.argsort(own, kind="stable")
    own, owner = own[order], owner[order]
    new = np.r_[True, (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])][: len(own)]
    return owner[new], own[new]


class Grams:
    """The distinct k-mers of a text, by their sorted hashes and one place each."""

    def __init__(self, text: str, size: int):
        self.text, self.size = text, size
        self.windows = np.lib.stride_tricks.sliding_window_view(_codes(text), size)
        hashes = _hashes(_codes(text), size)
        order = np.argsort(hashes)
        same = hashes[order][1:] == hashes[order][:-1]
        self.places = order[np.r_[True, ~same]]
        self.hashes = hashes[self.places]
        # whether k-mers of one hash are equal
        self.true = bool((self.windows[order[1:][same]] == self.windows[order[:-1][same]]).all())

    def share(self, other: Grams) -> float:
        """Common over all distinct k-mers, by their letters."""
        at = np.minimum(np.searchsorted(other.hashes, self.hashes), len(other.hashes) - 1)
        met = np.flatnonzero(other.hashes[at] == self.hashes)
        common, m, n = len(met), len(self.hashes), len(other.hashes)
        if not (self.true and other.true and (self.windows[self.places[met]] == other.windows[other.places[at[met]]]).all()):
            x, y = ({s.text[p : p + s.size] for p in range(len(s.text) - s.size + 1)} for s in (self, other))
            common, m, n = len(x & y), len(x), len(y)
        return common / (m + n - common)


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive groups of values as bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])


def shared_grams(texts: DataFrame, size: int, parts: int) -> DataFrame:
    """(no, n, own): of texts (no, seq) the k-mers that two of them share, and how many distinct ones each has.

    K-mers travel as hashes, packed by the part of all hashes in which they fall; a part sorts its own. ``own`` are
    pairs of 8-byte numbers, how many texts share a k-mer and its hash; a text has a row for each part.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, nos = batch["seq"].to_pylist(), batch["no"].to_numpy()
            ends = np.cumsum([max(len(s), size) for s in seqs]) // LETTERS
            for at in (np.flatnonzero(ends == k) for k in np.unique(ends)):
                owner, own = gram_hashes([seqs[i] for i in at], size)
                n = np.bincount(owner, minlength=len(at)).astype(np.int64)
                part = (own >> np.uint64(32)).astype(np.int64) * parts >> 32
                order = np.argsort(part * len(at) + owner)
                owner, counts = owner[order], np.bincount(part, minlength=parts)
                columns = [_packed(v, counts) for v in (nos[at][owner], n[owner], own[order])]
                yield pa.record_batch([pa.array(np.arange(parts, dtype=np.int32)), *columns], ["part", "nos", "ns", "hs"])

    def meet(table: pa.Table) -> pa.Table:
        no, n, h = (np.frombuffer(b"".join(table[c].to_pylist()), kind) for c, kind in (("nos", np.int64), ("ns", np.int64), ("hs", np.uint64)))
        order = np.argsort(h)
        starts = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]][: len(h)])
        often = np.empty(len(h), np.int64)
        often[order] = np.repeat(np.diff(np.r_[starts, len(h)]), np.diff(np.r_[starts, len(h)]))
        held = np.flatnonzero(often > 1)
        held = held[np.argsort(no[held], kind="stable")]
        starts = np.flatnonzero(np.r_[True, no[held][1:] != no[held][:-1]][: len(held)])
        pairs = np.stack([often[held], h[held].view(np.int64)], axis=1).ravel()
        return pa.table([pa.array(no[held][starts]), pa.array(n[held][starts]), _packed(pairs, 2 * np.diff(np.r_[starts, len(held)]))], ["no", "n", "own"])

    sent = texts.select("no", "seq").mapInArrow(send, "part int, nos binary, ns binary, hs binary").where("length(hs) > 0")
    return sent.repartition(parts, "part").groupBy("part").applyInArrow(meet, "no long, n long, own binary")


def similar_sequences(sequences: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b, jaccard): pairs of sequences whose distinct k-mers overlap by ``least`` or more of all they have.

    Equal sequences are compared once. With the k-mers of every sequence in one order, the rarest first, two sequences
    that are alike enough share one of their first n - ceil(least * n) + 1; candidates meet on these, so that a k-mer
    of very many sequences seldom brings any together, and are counted on all k-mers of their texts. No pair is lost:
    k-mers travel as 64-bit hashes, and two that fall together can only add a candidate; for two of one text one more
    k-mer is asked. Those of one sequence, which come first, go through one shuffle only; their number is all that is
    kept of them.
    """
    # texts are made and written once; ``no`` is the number of one of the rows that hold a text
    texts = Cut(sequences.where("seq is not null").select("seq_id", "seq", F.monotonically_increasing_id().alias("no")), "gram-texts").df
    members = Cut(texts.select("seq_id", "no", F.length("seq").alias("size"), F.min("no").over(Window.partitionBy("seq")).alias("first")), "gram-members").df
    firsts = members.where("no = first").select("no", "size")
    letters = firsts.agg(F.sum(F.greatest("size", F.lit(size)).cast("double"))).first()[0] or 0

    def firsts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, kept = batch["n"].to_numpy(), []
            for total, packed in zip(n, batch["own"].to_pylist()):
                often, h = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 2).T
                first = total - np.ceil(total * least - 1e-9) + 2 - (total - len(h))
                kept.append(h[np.lexsort((h, often))[: int(max(0, first))]])
            counts = [len(h) for h in kept]
            yield pa.record_batch([pa.array(np.repeat(batch["no"].to_numpy(), counts)), pa.array(np.repeat(n, counts)), pa.array(np.concatenate(kept))], ["no", "n", "h"])

    # as few bytes are much work, texts and parts are dealt to numbers of their own
    own = shared_grams(spread(texts, "no").join(spread(firsts, "no"), "no", "left_semi"), size, max(1, math.ceil(letters / GRAMS), sequences.sparkSession.sparkContext.defaultParallelism))
    gathered = own.groupBy("no", "n").agg(F.collect_list("own").alias("own"))
    keys = Cut(gathered.mapInArrow(firsts_of, "no long, n long, h long"), "grams").df
    # many k-mers of a stretch are shared by the same texts, which then meet once
    lists = keys.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("no", "n"))).alias("own")).where("size(own) > 1").select("own").distinct()
    met = lists.select(F.explode("own").alias("a"), "own").select("a", F.explode("own").alias("b")).where("a.no < b.no")
    met = met.where(F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * (least - 1e-9)).select(F.col("a.no").alias("a"), F.col("b.no").alias("b")).distinct()
    text = lambda side: texts.select(F.col("no").alias(side), F.col("seq").alias(f"seq_{side}"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Grams] = {}
        for batch in batches:
            shares = []
            for a, b, first, second in zip(*(batch[c].to_pylist() for c in ("a", "b", "seq_a", "seq_b"))):
                if min(len(first), len(second)) < size:  # one k-mer that no other text has
                    shares.append(0.0)
                    continue
                if sum(len(x.text) for x in held.values()) > LETTERS:
                    held = {}
                own = [held.get(k) or held.setdefault(k, Grams(s, size)) for k, s in ((a, first), (b, second))]
                shares.append(own[0].share(own[1]))
            yield pa.record_batch([batch["a"], batch["b"], pa.array(shares, pa.float64())], ["a", "b", "jaccard"])

    pairs = spread(Cut(met, "gram-pairs").df.join(text("a"), "a").join(text("b"), "b"), "b").sortWithinPartitions("b", "a")
    scored = pairs.select("a", "b", "seq_a", "seq_b").mapInArrow(counted, "a long, b long, jaccard double").where(F.col("jaccard") >= least)
    scored = scored.unionByName(firsts.select(F.col("no").alias("a"), F.col("no").alias("b"), F.lit(1.0).alias("jaccard")))
    left, right = members.select(F.col("seq_id").alias("x"), F.col("first").alias("a")), members.select(F.col("seq_id").alias("y"), F.col("first").alias("b"))
    pairs = scored.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")
