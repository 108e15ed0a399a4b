"""Words that differ by one letter, found by probing generated edits against Bloom filters and joined to the commonest form."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut

#: Letters of words; all of them lie below code point 256, so a word is as many bytes as it has letters.
LETTERS = "A-Za-zÀ-ÿ"
#: Words of this length and more share the filters of one length class.
LONGEST_CLASS = 64
BITS_PER_WORD, HASHES, BLOCK_BITS = 12, 5, 512
#: Words of one filter; with the bytes of a round it bounds what the driver and each worker hold of the vocabulary.
WORDS_PER_SHARD, ROUND_BYTES = 1 << 18, 32 << 20
#: Cells (words times positions) that one step of the edits works on.
CELLS = 1 << 16

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random 64-bit value of each letter, and the base of the polynomial hash of words.
_OF_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_BASE = np.uint64(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    """_BASE to the n-1st, ..., 1st, 0th power."""
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, _BASE), out=out[1:]) if n > 1 else None
    return out[::-1]


def _matrix(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def word_hashes(words: list[str]) -> np.ndarray:
    """Polynomial hashes of words of one length, mixed; replacing or deleting a letter changes them by a term or two."""
    letters = _matrix(words)
    return _mix((_OF_LETTER[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64))


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


@dataclass
class Filters:
    """Blocked Bloom filters of one round, one after another: of class c and part p, blocks[c][p] blocks from first[c][p] on.

    A class is a length (or all from LONGEST_CLASS on), its parts share the words by their hash. A part that this round
    does not hold has no block, and nothing is found in it.
    """

    bits: np.ndarray
    first: dict[int, np.ndarray]
    blocks: dict[int, np.ndarray]

    def hits(self, length: int, mixed: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be words of this length in the round's parts."""
        c = min(length, LONGEST_CLASS)
        if c not in self.first:
            return np.empty(0, np.int64)
        part = (mixed >> np.uint64(40)) % np.uint64(len(self.first[c]))
        blocks = self.blocks[c][part.astype(np.int64)]
        left = np.flatnonzero(blocks)
        mixed, part, blocks = mixed[left], part[left].astype(np.int64), blocks[left]
        block = self.first[c][part] + (mixed & np.uint64(0xFFFFFFFF)) % blocks
        places = _mix(mixed + _STEP)
        for k in range(HASHES):
            at = places >> np.uint64(9 * k) & np.uint64(511)
            there = (self.bits[(block * np.uint64(8) + (at >> np.uint64(6))).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
            left, block, places = left[there], block[there], places[there]
        return left


def _filter_of(mixed: np.ndarray, blocks: int) -> np.ndarray:
    bits = np.zeros(blocks * BLOCK_BITS // 64, np.uint64)
    block = (mixed & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)
    places = _mix(mixed + _STEP)
    for k in range(HASHES):
        at = places >> np.uint64(9 * k) & np.uint64(511)
        np.bitwise_or.at(bits, (block * np.uint64(8) + (at >> np.uint64(6))).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return bits


def edits_in(words: list[str], filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(place of a word, an edit of it that the filters do not rule out), for words of one length.

    Edits are all deletions, and replacements by a later letter: every pair of near words is then met from one side,
    the longer or the earlier word. Of a run of equal letters one deletion stands for all.
    """
    letters = _matrix(words)
    n = letters.shape[1]
    powers = _powers(n)
    for low in range(0, len(words), max(1, CELLS // n)):
        own = letters[low : low + max(1, CELLS // n)]
        terms = _OF_LETTER[own] * powers
        whole = terms.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(_OF_LETTER[own[:, :-1]] * powers[1:], axis=1, dtype=np.uint64)
        before = np.concatenate([np.zeros((len(own), 1), np.uint64), before], axis=1)
        after = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
        alone = np.concatenate([np.ones((len(own), 1), bool), own[:, 1:] != own[:, :-1]], axis=1)
        row, at = np.nonzero(alone)
        for i in filters.hits(n - 1, _mix((before + after)[row, at])):
            word, p = words[low + row[i]], at[i]
            yield low + int(row[i]), word[:p] + word[p + 1 :]
        rest = whole[:, None] - terms
        for letter in alphabet:
            row, at = np.nonzero(own < letter)
            for i in filters.hits(n, _mix(rest[row, at] + _OF_LETTER[letter] * powers[at])):
                word, p = words[low + row[i]], at[i]
                yield low + int(row[i]), word[:p] + chr(letter) + word[p + 1 :]


def dropped_letters(doc_id: Column, run: Column) -> Column:
    """The run without one letter where its document's checksum says so: h = crc32 of doc_id:run, 31 divides h, letter h % length.

    A null doc_id drops none.
    """
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    p = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), p), F.substring(run, p + 2, F.length(run)))
    return F.when(h % 31 == 0, without).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of all runs of letters in whole texts, A-Z lower-cased, as ``dropped_letters`` has them."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least_length},}})"), 1)).alias("run"))
    lower = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    words = runs.select("doc_id", lower.alias("run")).select(dropped_letters(F.col("doc_id"), F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _class(word: Column) -> Column:
    return F.least(F.length(word), F.lit(LONGEST_CLASS))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch["word"].to_pylist()
        for n, rows in _by_length(words):
            mixed = word_hashes([words[i] for i in rows]).view(np.int64)
            yield pa.record_batch({"class": np.full(len(mixed), min(n, LONGEST_CLASS), np.int32), "mixed": mixed})


def _rounds(sizes: dict[int, int], words_per_shard: int, round_bytes: int) -> tuple[dict[int, int], list[list[tuple[int, int]]]]:
    """(parts of each class, rounds of (class, part)), so that a round's filters have no more than ``round_bytes`` bytes."""
    parts = {c: -(-n // words_per_shard) for c, n in sizes.items()}
    rounds, used = [[]], 0
    for c in sorted(parts):
        # a part has about its share of the words; twice as many are allowed for
        size = 2 * (sizes[c] // parts[c] + 1) * BITS_PER_WORD // 8 + BLOCK_BITS // 8
        for p in range(parts[c]):
            if rounds[-1] and used + size > round_bytes:
                rounds, used = [*rounds, []], 0
            rounds[-1].append((c, p))
            used += size
    return parts, rounds


def _build(hashes: DataFrame, parts: dict[int, int], held: list[tuple[int, int]]) -> Filters:
    """The filters of a round: each made in one task from the hashes of its words, then brought together on the driver."""
    count = F.create_map(*(F.lit(x) for c in {c for c, _ in held} for x in (c, parts[c])))
    # the unsigned upper bits of the hash, as the probing side takes them
    part = (F.shiftrightunsigned("mixed", 40) % count[F.col("class")]).cast("int")
    wanted = hashes.where(F.col("class").isin([c for c, _ in held])).withColumn("part", part)
    pairs = F.array(*(F.lit(c * (1 << 32) + p) for c, p in held))
    wanted = wanted.where(F.array_contains(pairs, F.col("class").cast("long") * (1 << 32) + F.col("part")))

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        mixed = rows["mixed"].to_numpy().view(np.uint64)
        bits = _filter_of(mixed, -(-len(mixed) * BITS_PER_WORD // BLOCK_BITS))
        return pd.DataFrame({"class": [key[0]], "part": [key[1]], "bits": [bits.tobytes()]})

    made = wanted.groupBy("class", "part").applyInPandas(build, "class int, part int, bits binary").collect()
    classes = {c for c, _ in held}
    first = {c: np.zeros(parts[c], np.uint64) for c in classes}
    blocks = {c: np.zeros(parts[c], np.uint64) for c in classes}
    used = 0
    for row in made:
        size = len(row["bits"]) * 8 // BLOCK_BITS
        first[row["class"]][row["part"]], blocks[row["class"]][row["part"]] = used, size
        used += size
    return Filters(np.frombuffer(b"".join(bytes(row["bits"]) for row in made), np.uint64), first, blocks)


def near_words(words: DataFrame, words_per_shard: int = WORDS_PER_SHARD, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, near, near_n): words (word, n) that differ by one inserted, deleted or replaced letter, in both directions.

    Every word's edits are probed against Bloom filters of the vocabulary by length; only those found there are shuffled to
    the join with the vocabulary, which takes out the false ones. Filters are broadcast in rounds of ``round_bytes`` at most,
    as many as the vocabulary needs, so that no process holds more of it. ``words`` should be a written table: it is read
    once a round.
    """
    spark = words.sparkSession
    sizes = {r["class"]: r["n"] for r in words.groupBy(_class(F.col("word")).alias("class")).agg(F.count("*").alias("n")).collect()}
    schema = "word string, n long, near string"
    if not sizes:
        return spark.createDataFrame([], schema + ", near_n long")
    # at most as many letters as LETTERS has
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("x")).where("x <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["x"]) for r in letters), np.uint8)
    spread = max(spark.sparkContext.defaultParallelism, sum(sizes.values()) // 20_000 + 1)
    spread_words = words.repartition(spread, "word")
    hashes = words.select("word").mapInArrow(_hashed, "class int, mixed long")
    parts, rounds = _rounds(sizes, words_per_shard, round_bytes)
    real = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = None
    for held in rounds:
        shared = spark.sparkContext.broadcast(_build(hashes, parts, held))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters = shared.value
            for batch in batches:
                texts, counts = batch["word"].to_pylist(), batch["n"].to_pylist()
                for _, rows in _by_length(texts):
                    own = [texts[i] for i in rows]
                    hits = [(rows[i], edit) for i, edit in edits_in(own, filters, alphabet)]
                    columns = [texts[i] for i, _ in hits], [counts[i] for i, _ in hits], [e for _, e in hits]
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.string()))], ["word", "n", "near"])

        reach = sorted({x for c, _ in held for x in (c, min(c + 1, LONGEST_CLASS))})
        hits = spread_words.where(_class(F.col("word")).isin(reach)).mapInArrow(probe, schema)
        found = Cut(hits.join(real, "near").select("word", "n", "near", "near_n"), "near-words").df
        shared.destroy()
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of forms, for words (word, form) that have one.

    Each round joins chains to what their ends lead to, so lengths double; every form is at least ten times as common as
    its word, so there are few rounds.
    """
    now = Cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.df.select(F.col("word").alias("root"), F.col("root").alias("on"))
        joined = Cut(now.df.join(further, "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        moved = joined.df.where("moved").head(1)
        now.drop()
        if not moved:
            return joined.df.select("word", "root")
        now = Cut(joined.df.select("word", "root"), "roots")
        joined.drop()


def variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, words_per_shard: int = WORDS_PER_SHARD, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``vocabulary(docs)``.

    A word's form is its commonest near word, of equal ones the first in code-point order, if it is ``ratio`` times as
    common as the word; the root is where forms end. Null texts have no words and an empty table gives an empty table;
    each of repeated rows counts; other columns of ``docs`` are not read.
    """
    words = Cut(vocabulary(docs, least_length, least_count), "words").df
    near = near_words(words, words_per_shard, round_bytes)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("n").alias("own"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b"))
    fits = -F.col("b.k") >= ratio * F.col("own")
    judged = Cut(best.select("word", "n_near", F.when(fits, F.col("b.near")).alias("form"), F.when(fits, -F.col("b.k")).alias("form_n")), "forms").df
    ends = roots(judged.where("form is not null").select("word", "form"))
    out = words.join(judged, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
