"""Splice-site scores by tables of sub-words, the best site in a window, and the search for missing exons."""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from strandweave.functions import sequence as S
from strandweave.operators.pairwise import GAP, align
from strandweave.session import Cut, spread

# Background of the bases and the shares of each base at the two consensus places of both kinds of sites.
BACKGROUND = {"A": 0.27, "C": 0.23, "G": 0.23, "T": 0.27}
DONOR = ({"A": 0.004, "C": 0.0032, "G": 0.9896, "T": 0.0032}, {"A": 0.0034, "C": 0.0039, "G": 0.0042, "T": 0.9884})
ACCEPTOR = ({"A": 0.9903, "C": 0.0032, "G": 0.0034, "T": 0.0030}, {"A": 0.0027, "C": 0.0037, "G": 0.9905, "T": 0.0030})
# Place and length of the nine sub-words of the 21 letters beside an acceptor's consensus; the last four divide.
PARTS = ((0, 7), (7, 7), (14, 7), (4, 7), (11, 7), (4, 3), (7, 4), (11, 3), (14, 4))
DIVISORS_FROM = 5
#: Spaced seeds of eleven bases each for the search of exons; two of them on about one diagonal make a candidate.
SEEDS = ("111010010100110111", "110100110010101111", "1110110010100010111", "111001010011001111")
COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")
_BASE_CODES = np.full(256, 4, np.int64)
_BASE_CODES[np.frombuffer(b"ACGTacgt", np.uint8)] = [0, 1, 2, 3] * 2


def _log_consensus(site: Column, place: int, shares: tuple[dict, dict]) -> Column:
    """log2 of the odds of the two consensus letters, the first at a 1-based place; null for other letters."""
    out = F.lit(0.0)
    for shift, share in enumerate(shares):
        odds = F.lit(None).cast("double")
        for base, value in share.items():
            odds = F.when(F.substring(site, place + shift, 1) == base, value / BACKGROUND[base]).otherwise(odds)
        out = out + F.log2(odds)
    return out


def donor_rest(site: Column) -> Column:
    """The seven letters of a 9-mer beside its consensus."""
    return F.concat(F.substring(site, 1, 3), F.substring(site, 6, 4))


def acceptor_words(site: Column) -> Column:
    """[(part, word)] of the nine sub-words of a 23-mer."""
    rest = F.concat(F.substring(site, 1, 18), F.substring(site, 21, 3))
    return F.array(*(F.struct(F.lit(k).alias("part"), F.substring(rest, at + 1, n).alias("word")) for k, (at, n) in enumerate(PARTS)))


def donor_scores(sites: DataFrame, table: DataFrame) -> DataFrame:
    """``score`` of each 9-mer ``site`` by a table (word, value) of its other letters; sites without an entry are left out.

    The table has at most 4^7 rows, so it is broadcast.
    """
    scored = sites.withColumn("word", donor_rest(F.col("site"))).join(F.broadcast(table), "word")
    return scored.withColumn("score", _log_consensus(F.col("site"), 4, DONOR) + F.log2("value")).where("score is not null").drop("word", "value")


def acceptor_scores(sites: DataFrame, tables: DataFrame) -> DataFrame:
    """(site, score) of the distinct 23-mers by tables (part, word, value); a site with a word that is in no table is left out.

    The tables have at most 5 x 4^7 and some smaller rows, so they are broadcast.
    """
    words = sites.select("site").distinct().select("site", F.inline(acceptor_words(F.col("site"))))
    sign = F.when(F.col("part") < DIVISORS_FROM, 1).otherwise(-1)
    summed = words.join(F.broadcast(tables), ["part", "word"]).groupBy("site").agg(F.sum(sign * F.log2("value")).alias("s"), F.count("*").alias("n")).where(F.col("n") == len(PARTS))
    return summed.select("site", (F.col("s") + _log_consensus(F.col("site"), 19, ACCEPTOR)).alias("score")).where("score is not null")


def best_donor(windows: DataFrame, table: DataFrame, least: float, compat_zero: bool = True) -> DataFrame:
    """(window_id, shift, score): the best 9-mer of each window (window_id, text) without N, from a least score on.

    Of equal scores the least shift counts. With ``compat_zero`` a best site at shift 0 counts as none.
    """
    last = F.length("text") - 9
    sites = windows.where(last >= 0).select("window_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("shift"))
    sites = sites.select("window_id", "shift", F.substring(F.col("text"), F.col("shift") + 1, F.lit(9)).alias("site")).where(~F.contains("site", F.lit("N")))
    # rounded, so that equal scores are equal whatever the order of their sums
    scored = donor_scores(sites, table).withColumn("score", F.round("score", 9))
    best = scored.groupBy("window_id").agg(F.max(F.struct("score", (-F.col("shift")).alias("k"))).alias("b"))
    out = best.select("window_id", (-F.col("b.k")).alias("shift"), F.col("b.score").alias("score")).where(F.col("score") >= least)
    return out.where("shift <> 0") if compat_zero else out


def best_sites(windows: DataFrame, before: int, behind: int, score, least: float, compat_zero: bool = True) -> DataFrame:
    """(window_id, shift, score): the best site of each window (window_id, text, zero, low, high) at shifts low to high - 1 of its joint.

    ``zero`` is the 0-based place of the joint; a site has ``before`` bases ahead of the shifted joint and ``behind`` after
    it, lies in the text and has no N. ``score`` makes (site, score) of distinct sites; of equal scores the least shift
    counts. Sites under ``least`` are none, and with ``compat_zero`` so is a best site at a window's first possible shift.
    """
    shifts = F.explode(F.sequence(F.col("low"), F.col("high") - 1))
    rows = windows.where("low < high and text is not null").select("window_id", "text", "zero", shifts.alias("shift"))
    start = F.col("zero") + F.col("shift") - before
    rows = rows.where((start >= 0) & (start + before + behind <= F.length("text")))
    sites = rows.select("window_id", "shift", F.substring(F.col("text"), (start + 1).cast("int"), F.lit(before + behind)).alias("site")).where(~F.contains("site", F.lit("N")))
    sites = sites.withColumn("is_first", F.col("shift") == F.min("shift").over(Window.partitionBy("window_id")))
    # rounded, so that equal scores are equal whatever the order of their sums
    scored = sites.join(score(sites.select("site").distinct()).select("site", F.round("score", 9).alias("score")), "site")
    best = scored.groupBy("window_id").agg(F.max(F.struct("score", (-F.col("shift")).alias("back"), "is_first")).alias("b")).where(F.col("b.score") >= least)
    out = best.where("not b.is_first") if compat_zero else best
    return out.select("window_id", (-F.col("b.back")).alias("shift"), "b.score")


def best_acceptor(windows: DataFrame, tables: DataFrame, least: float = 3.0, compat_zero: bool = True) -> DataFrame:
    """The best 23-mer, 20 bases of the flank and 3 of the exon, of each window; see ``best_sites``."""
    return best_sites(windows, 20, 3, lambda sites: acceptor_scores(sites, tables), least, compat_zero)


def cleaned_exons(exons: DataFrame, acceptors: DataFrame, donors: DataFrame, least: float = 3.0, least_left: float = 6.0, reach: int = 10, donor_step: int = 1) -> DataFrame:
    """Novel exons with their ends moved to the best splice sites; those that then do not hold together are left out.

    ``exons`` is (exon_id, left_flank, dna, right_flank, pep, transl_start, transl_end, template_dna, template_pep,
    is_first, is_mitochondrial); tables are those of ``acceptor_scores`` and ``donor_scores``. In order:

    * what lies outside the translated part goes to the flanks; a length that is no multiple of three loses its rest at
      the start, or else at the end, whichever gives the stored peptide, and is rejected if neither does;
    * a first exon begins at its own ATG or the one nearest its joint in steps of three, if the template begins with M;
      other exons at the best acceptor, ``reach`` bases to both sides and as many more as the template is longer (shorter: on the other side),
      which counts from ``least_left``; the end is ``donor_step`` bases behind the best donor, from ``least``;
    * the peptide is read between the phases that both shifts leave; where one end alone has a site, what is left over
      by three counts at the other end;
    * the exon is accepted if flanks and exon have their total length, the translated part is a multiple of three and
      the peptide has no stop that the stored one has not.

    Result: (exon_id, left_flank, dna, right_flank, pep, transl_start, transl_end, phase, end_phase, left_score,
    right_score, start_shift, end_shift), shifts in bases along the reading direction, scores null where no site counts
    (and for a start codon). Exons without any site stay as they are after the first step. Null texts count as empty.
    """
    texts = ("left_flank", "dna", "right_flank", "pep", "template_dna", "template_pep")
    rows = exons.withColumns({c: F.coalesce(c, F.lit("")) for c in texts})
    part = lambda text, first, n: F.substring(text, (first + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int"))
    size = F.length("dna")
    inside = F.col("transl_end") - F.col("transl_start") == size
    trimmed = {
        "left_flank": F.when(inside, F.col("left_flank")).otherwise(F.concat("left_flank", part(F.col("dna"), F.lit(0), F.col("transl_start")))),
        "right_flank": F.when(inside, F.col("right_flank")).otherwise(F.concat(part(F.col("dna"), F.col("transl_end"), size - F.col("transl_end")), "right_flank")),
        "dna": F.when(inside, F.col("dna")).otherwise(part(F.col("dna"), F.col("transl_start"), F.col("transl_end") - F.col("transl_start"))),
        "cut_left": F.when(inside, 0).otherwise(F.col("transl_start")), "cut_right": F.when(inside, 0).otherwise(size - F.col("transl_end")),
    }
    rows = rows.withColumns(trimmed)
    rest = size % 3
    from_left, from_right = part(F.col("dna"), rest, size - rest), part(F.col("dna"), F.lit(0), size - rest)
    side = F.when(rest == 0, 0).when(S.translate(from_left) == F.col("pep"), 1).when(S.translate(from_right) == F.col("pep"), 2)
    rows = rows.withColumns({"side": side, "rest": rest})
    rows = rows.withColumns({
        "left_flank": F.when(F.col("side") == 1, F.concat("left_flank", part(F.col("dna"), F.lit(0), F.col("rest")))).otherwise(F.col("left_flank")),
        "right_flank": F.when(F.col("side") == 2, F.concat(part(F.col("dna"), size - F.col("rest"), F.col("rest")), "right_flank")).otherwise(F.col("right_flank")),
        "dna": F.when(F.col("side") == 1, from_left).when(F.col("side") == 2, from_right).otherwise(F.col("dna")),
        "cut_left": F.col("cut_left") + F.when(F.col("side") == 1, F.col("rest")).otherwise(0), "cut_right": F.col("cut_right") + F.when(F.col("side") == 2, F.col("rest")).otherwise(0),
    })
    # asked behind the cut, as a filter before it would work out the texts and their peptides a second time
    rows = Cut(rows.drop("transl_start", "transl_end", "rest"), "novel-exons").df.where("side is not null").drop("side")
    # how far to look: further outwards at both ends where the template is longer, inwards where it is shorter
    apart = F.abs(size - F.length("template_dna"))
    shorter = size < F.length("template_dna")
    out, in_ = F.when(shorter, reach + apart).otherwise(F.lit(reach)), F.when(shorter, F.lit(reach)).otherwise(reach + apart)
    left_windows = rows.where("not is_first").select(F.col("exon_id").alias("window_id"), F.concat("left_flank", "dna").alias("text"), F.length("left_flank").alias("zero"), (-out).alias("low"), in_.alias("high"))
    right_windows = rows.select(F.col("exon_id").alias("window_id"), F.concat("dna", "right_flank").alias("text"), size.alias("zero"), (-in_).alias("low"), out.alias("high"))
    left = best_acceptor(left_windows, acceptors, least).where(F.col("score") >= least_left).select(F.col("window_id").alias("exon_id"), F.col("shift").alias("left_shift"), F.col("score").alias("left_score"))
    right = best_sites(right_windows, 3, 9, lambda sites: donor_scores(sites.select(F.col("site").alias("whole"), F.left("site", F.lit(9)).alias("site")), donors).select(F.col("whole").alias("site"), "score"), least)
    right = right.select(F.col("window_id").alias("exon_id"), (F.col("shift") + donor_step).alias("right_shift"), F.col("score").alias("right_score"))
    both = F.concat("left_flank", "dna")
    begin = S.start_codon(both, F.length("left_flank"), F.floor((12 + F.when(shorter, apart).otherwise(0)) / 3).cast("int"), F.floor((12 + F.when(shorter, 0).otherwise(apart)) / 3).cast("int"))
    begin = F.when(F.startswith("dna", F.lit("ATG")), F.length("left_flank")).otherwise(begin)
    starts = F.when(F.col("is_first") & F.startswith("template_pep", F.lit("M")), begin - F.length("left_flank"))
    found = rows.join(left, "exon_id", "left").join(right, "exon_id", "left").withColumn("left_shift", F.coalesce("left_shift", starts))
    l, r = F.coalesce("left_shift", F.lit(0)), F.coalesce("right_shift", F.lit(0))
    whole = F.concat("left_flank", "dna", "right_flank")
    begins, ends = F.length("left_flank") + l, F.length("left_flank") + size + r
    moved = found.withColumns({"whole": whole, "begins": begins, "ends": ends, "left_ok": F.col("left_shift").isNotNull(), "right_ok": F.col("right_shift").isNotNull()})
    moved = moved.where((F.col("begins") >= 0) & (F.col("begins") < F.col("ends")) & (F.col("ends") <= F.length("whole")))
    width = F.col("ends") - F.col("begins")
    phase = F.when(F.col("left_ok") & ~F.col("is_first"), F.pmod(l, F.lit(3))).otherwise(0)
    moved = moved.withColumns({"first": F.when(F.col("left_ok"), (3 - phase) % 3).otherwise(0), "last": width - F.when(F.col("right_ok"), F.pmod(r, F.lit(3))).otherwise(0), "phase": phase, "end_phase": F.when(F.col("right_ok"), F.pmod(r, F.lit(3))).otherwise(0)})
    over = F.pmod(F.col("last") - F.col("first"), F.lit(3))
    only_left, only_right = F.col("left_ok") & ~F.col("right_ok"), F.col("right_ok") & ~F.col("left_ok")
    moved = moved.withColumns({"end_phase": F.when(only_left, over).otherwise(F.col("end_phase")), "phase": F.when(only_right, over).otherwise(F.col("phase")), "transl_end": F.when(only_left, F.col("last") - over).otherwise(F.col("last")), "transl_start": F.when(only_right, F.col("first") + over).otherwise(F.col("first"))})
    moved = moved.withColumn("new_dna", part(F.col("whole"), F.col("begins"), width))
    coding = part(F.col("new_dna"), F.col("transl_start"), F.col("transl_end") - F.col("transl_start"))
    read = F.when(F.col("is_mitochondrial"), S.translate(coding, mitochondrial=True)).otherwise(S.translate(coding))
    named = moved.withColumn("new_pep", read).where(((F.col("transl_end") - F.col("transl_start")) % 3 == 0) & (F.col("transl_end") >= F.col("transl_start")) & (~F.contains("new_pep", F.lit("*")) | F.contains("pep", F.lit("*"))))
    return named.select(
        "exon_id", part(F.col("whole"), F.lit(0), F.col("begins")).alias("left_flank"), F.col("new_dna").alias("dna"), part(F.col("whole"), F.col("ends"), F.length("whole") - F.col("ends")).alias("right_flank"), F.col("new_pep").alias("pep"),
        F.col("transl_start").cast("int").alias("transl_start"), F.col("transl_end").cast("int").alias("transl_end"), F.col("phase").cast("int").alias("phase"), F.col("end_phase").cast("int").alias("end_phase"), "left_score", "right_score", (l + F.col("cut_left")).cast("int").alias("start_shift"), (r - F.col("cut_right")).cast("int").alias("end_shift"),
    )


def _letters(text: str) -> np.ndarray:
    """0 to 3 for the bases of a text in either case, 4 for other letters."""
    return _BASE_CODES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]


def seed_words(text: str, pattern: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, words, plain): the bases that a spaced seed picks at each place of a text where all of them are bases.

    Words are packed two bits a base; plain ones have one or two bases only, as words of repeats do.
    """
    codes = _letters(text)
    n = len(codes) - len(pattern) + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    word, known, seen = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int64)
    for at in (i for i, c in enumerate(pattern) if c == "1"):
        own = codes[at : at + n]
        word, known, seen = word * 4 + own, known & (own < 4), seen | 1 << own
    return np.flatnonzero(known), word[known], np.bitwise_count(seen[known]) <= 2


def _by_bin(query: np.ndarray, bins: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """(query, bin, n, lo, hi) with one row for each query and bin."""
    key = query * (1 << 40) + bins + (1 << 39)
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    if not len(starts):
        return query, bins, n, lo, hi
    query, bins = query[order][starts], bins[order][starts]
    return query, bins, np.add.reduceat(n[order], starts), np.minimum.reduceat(lo[order], starts), np.maximum.reduceat(hi[order], starts)


def seed_bins(templates: list[str], text: str, start: int, places: int, bin_width: int, at_once: int = 1 << 20) -> tuple[np.ndarray, ...]:
    """(template, bin, n, lo, hi): seeds of templates that lie in the first ``places`` of a text, counted by bins of diagonals that overlap by half.

    ``lo`` and ``hi`` are the least and the greatest diagonal, counted from ``start`` on.
    """
    gap = max(map(len, SEEDS))
    sizes = np.array([len(s) + gap for s in templates], np.int64)
    begins, joined = np.cumsum(sizes) - sizes, "".join(s + "N" * gap for s in templates)
    done = [tuple(np.empty(0, np.int64) for _ in range(5))]
    for pattern in SEEDS:
        at, word, _ = seed_words(text, pattern)
        inside = at < places
        order = np.argsort(word[inside])
        at, word = at[inside][order] + start, word[inside][order]
        own_at, own, _ = seed_words(joined, pattern)
        left = np.searchsorted(word, own, "left")
        many = np.searchsorted(word, own, "right") - left
        met = np.flatnonzero(many)
        own_at, left, many = own_at[met], left[met], many[met]
        query = np.searchsorted(begins, own_at, "right") - 1
        # words of repeats have very many hits, which are counted some at a time
        step = np.cumsum(many) // at_once
        for part in np.split(np.arange(len(met)), np.flatnonzero(np.diff(step)) + 1):
            hit = np.repeat(part, many[part])
            place = np.arange(len(hit)) - np.repeat(np.cumsum(many[part]) - many[part], many[part])
            diagonal = at[left[hit] + place] - (own_at[hit] - begins[query[hit]])
            bins = np.concatenate([diagonal // bin_width - 1, diagonal // bin_width])
            twice = np.concatenate([diagonal, diagonal])
            done.append(_by_bin(np.tile(query[hit], 2), bins, np.ones(len(twice), np.int64), twice, twice))
    return _by_bin(*(np.concatenate(x) for x in zip(*done)))


def search_windows(templates: DataFrame, pieces: DataFrame, searches: DataFrame, piece: int, bin_width: int, slack: int, queries: int) -> DataFrame:
    """(query_id, target_id, strand, lo, hi): stretches of a target, 0-based and half open, where two seeds of a template lie on about one diagonal.

    A piece of a target and up to about ``queries`` of the templates that are searched in it are one unit of work, which
    finds the seeds of both strands in the piece. Hits count per bin of diagonals, bins overlap by half, and bins with
    two hits that touch are one stretch, wider by the template and some slack on both sides.
    """
    kinds = {f.name: f.dataType.simpleString() for f in searches.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                text, start, asked = batch["seq"][r].as_py(), batch["start"][r].as_py(), batch["asked"][r].values
                ids, texts = asked.field("query_id"), asked.field("seq").to_pylist()
                size = np.array([len(s) for s in texts], np.int32)
                for strand, own in ((1, texts), (-1, [s.translate(COMPLEMENT)[::-1] for s in texts])):
                    query, bins, n, lo, hi = seed_bins(own, text, start, piece, bin_width)
                    # in a target of one piece a single hit meets no other
                    held = np.flatnonzero((n > 1) | (batch["total"][r].as_py() > piece))
                    query, columns = query[held], [x[held] for x in (bins, n, lo, hi)]
                    yield pa.record_batch([ids.take(pa.array(query)), pa.repeat(batch["target_id"][r], len(held)), pa.array(np.full(len(held), strand, np.int32)), pa.array(size[query]), *map(pa.array, columns)], ["query_id", "target_id", "strand", "size", "bin", "n", "lo", "hi"])

    many = F.ceil(F.count("*").over(Window.partitionBy("target_id")) / queries)
    # files of ids and places are far smaller than their rows in memory, so their size must not make a join broadcast them
    asked = searches.withColumn("salt", F.pmod(F.xxhash64("query_id"), many)).join(templates.select("query_id", "seq").hint("merge"), "query_id")
    asked = asked.groupBy("target_id", "salt").agg(F.collect_list(F.struct("query_id", "seq")).alias("asked"))
    units = pieces.select("target_id", "total", "start", "seq").join(asked.hint("merge"), "target_id")
    spark = searches.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(searches.count() / 50_000))
    units = units.repartition(parts, "target_id", "start", "salt").select("target_id", "total", "start", "seq", "asked")
    found = units.mapInArrow(work, f"query_id {kinds['query_id']}, target_id {kinds['target_id']}, strand int, size int, bin long, n long, lo long, hi long")
    key = ["query_id", "target_id", "strand"]
    full = found.groupBy(*key, "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("size").alias("size")).where("n >= 2")
    w = Window.partitionBy(*key).orderBy("bin")
    islands = full.withColumn("new", (F.col("bin") - F.lag("bin", 1, -(1 << 40)).over(w) > 2).cast("int")).withColumn("island", F.sum("new").over(w))
    spans = islands.groupBy(*key, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("size").alias("size"))
    return spans.select(*key, F.greatest(F.col("lo") - slack, F.lit(0)).alias("lo"), (F.col("hi") + F.col("size") + slack).alias("hi"))


def best_places(rows: DataFrame, slack: int) -> DataFrame:
    """(query_id, target_id, strand, lo, hi): around the place of each piece (target_id, start, seq) that has most bases of a short template ``own``.

    The template is laid on every place of the piece without gaps, on both strands; the first of equal places counts.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = [], []
            for own, text, start in zip(*(batch[c].to_pylist() for c in ("own", "seq", "start"))):
                there, forward = _letters(text), _letters(own)
                for letters in (forward, np.where(forward < 4, 3 - forward, 4)[::-1]):
                    n = max(1, len(there) - len(letters) + 1)
                    equal = np.zeros(n, np.int64)
                    for k, base in enumerate(letters):
                        beside = there[k : k + n]
                        equal[: len(beside)] += (beside == base) & (base < 4)
                    at = start + int(np.argmax(equal))
                    lo.append(max(0, at - slack))
                    hi.append(at + len(letters) + slack)
            twice = [pa.array(batch[c].to_pylist(), batch[c].type).take(pa.array(np.arange(len(batch)).repeat(2))) for c in ("query_id", "target_id")]
            strands = pa.array(np.tile(np.array([1, -1], np.int32), len(batch)))
            yield pa.record_batch([*twice, strands, pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["query_id", "target_id", "strand", "lo", "hi"])

    return rows.mapInArrow(work, f"query_id {kinds['query_id']}, target_id {kinds['target_id']}, strand int, lo long, hi long")


def missing_exons(templates: DataFrame, regions: DataFrame, searches: DataFrame, piece: int = 15_000, bin_width: int = 16, slack: int = 32, shortest: int = 36, queries: int = 256, least_share: float = 0.4, least_identity: float = 10.0) -> DataFrame:
    """(query_id, target_id, strand, match_length, identity, first): the best place of each template in each region that it is searched in.

    ``templates`` is (query_id, seq), ``regions`` (target_id, seq), ``searches`` (query_id, target_id). Regions are cut to
    overlapping pieces; what ``search_windows`` finds in them is aligned with the template on its strand. Templates too
    short for two seeds, under ``shortest`` bases, are aligned around their best place in each piece. Of the
    matches that are long and alike enough the one with most equal columns stays, then the longest, the forward strand,
    the first place. ``first`` is the 0-based place in the whole region, ``match_length`` its aligned bases. Null and
    empty texts find nothing; query_id and target_id are keys.
    """
    longest_seed = max(map(len, SEEDS))
    searches = Cut(searches.select("query_id", "target_id").distinct(), "searches").df
    templates = Cut(templates.where("seq <> ''").join(searches.hint("merge"), "query_id", "left_semi"), "templates").df
    regions = Cut(regions.where("seq <> ''").join(searches.hint("merge"), "target_id", "left_semi"), "regions").df
    starts = F.sequence(F.lit(0), F.length("seq") - 1, F.lit(piece))
    cut = lambda size: regions.select("target_id", F.length("seq").alias("total"), F.posexplode(starts).alias("chunk_no", "start"), "seq").select("target_id", "total", "chunk_no", F.col("start").cast("long").alias("start"), F.substring(F.col("seq"), F.col("start") + 1, F.lit(size)).alias("seq"))
    long = F.length("seq") >= shortest
    windows = search_windows(templates.where(long), cut(piece + longest_seed - 1), searches, piece, bin_width, slack, queries)
    short = templates.where(~long).select("query_id", F.col("seq").alias("own")).join(searches.hint("merge"), "query_id").join(cut(piece + shortest - 1).select("target_id", "start", "seq").hint("merge"), "target_id")
    all_windows = Cut(windows.unionByName(best_places(short, slack)), "search-windows").df
    wanted = F.explode(F.sequence(F.floor(F.col("lo") / piece).cast("int"), F.floor((F.col("hi") - 1) / piece).cast("int")))
    parts = all_windows.select("*", wanted.alias("chunk_no")).join(cut(piece).hint("merge"), ["target_id", "chunk_no"])
    inside = F.substring(F.col("seq"), (F.greatest(F.col("lo") - F.col("start"), F.lit(0)) + 1).cast("int"), (F.least(F.col("hi") - F.col("start"), F.lit(piece)) - F.greatest(F.col("lo") - F.col("start"), F.lit(0))).cast("int"))
    texts = parts.groupBy("query_id", "target_id", "strand", "lo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", inside.alias("seq")))), lambda x: x["seq"]), "").alias("second"))
    own = templates.select("query_id", F.col("seq").alias("own"))
    turned = F.when(F.col("strand") < 0, S.reverse_complement(F.col("own"))).otherwise(F.col("own"))
    mark = lambda c: F.concat(F.lit("B"), F.upper(c), F.lit("Z"))
    pairs = texts.join(own.hint("merge"), "query_id").select(F.col("query_id").alias("a_id"), F.col("target_id").alias("b_id"), "strand", F.col("lo").alias("offset"), mark(turned).alias("first"), mark("second").alias("second"))
    tidy = lambda c: F.translate(c, GAP + "BZ", "---")
    aligned = align(pairs).select("a_id", "b_id", "strand", "offset", tidy("first").alias("x"), tidy("second").alias("y"))
    line = S.cigar(F.col("x"), F.col("y"))
    lead = F.aggregate(F.regexp_extract_all(F.regexp_extract(line, r"^((?:\d+[AB])*)", 1), F.lit(r"(\d+)A"), 1), F.lit(0), lambda s, v: s + v.cast("int"))
    matched = F.aggregate(F.regexp_extract_all(line, F.lit(r"(\d+)M"), 1), F.lit(0), lambda s, v: s + v.cast("int"))
    equal = S._pairs(F.col("x"), F.col("y"), lambda p, q: (p == q) & (p != "-"))
    hits = aligned.select(F.col("a_id").alias("query_id"), F.col("b_id").alias("target_id"), "strand", matched.alias("match_length"), equal.alias("equal"), (F.col("offset") + lead).alias("first"), F.least(S.ungapped_length(F.col("x")), S.ungapped_length(F.col("y"))).alias("shorter"))
    good = hits.withColumn("identity", 100.0 * F.col("equal") / F.greatest("match_length", F.lit(1))).where((F.col("match_length") >= least_share * F.col("shorter")) & (F.col("match_length") > 0) & (F.col("identity") >= least_identity))
    best = good.groupBy("query_id", "target_id").agg(F.max(F.struct("equal", "match_length", "strand", (-F.col("first")).alias("back"), "identity")).alias("b"))
    return best.select("query_id", "target_id", "b.strand", "b.match_length", "b.identity", (-F.col("b.back")).alias("first"))


@F.pandas_udf(StructType([StructField("own", DoubleType()), StructField("ratio", DoubleType()), *(StructField(c, IntegerType()) for c in ("place", "at", "size"))]))
def likeness(own: pd.Series, peps: pd.Series, template: pd.Series, least: pd.Series) -> pd.DataFrame:
    """Likeness of a template to a peptide and to the most alike of several, the place of the first such one and its stretch.

    Likeness is the share in matching blocks, a stretch goes from the first block to the last. Each peptide is compared
    once, those that could be most alike by their letters first, and no others; none if the own one does already.
    """
    out = []
    for first, tried, other, enough in zip(own, peps, template, least, strict=True):
        matcher = SequenceMatcher(None, first, other)
        held = matcher.ratio()
        best, at, size = (-1.0, 0), 0, 0
        places: dict[str, int] = {}
        if first != other and (held <= enough or "*" in first):
            for k, pep in enumerate(tried):
                places.setdefault(pep, k)
        bounds = []
        for pep, k in places.items():
            matcher.set_seq1(pep)
            bounds.append((matcher.quick_ratio(), -k, pep))
        for bound, k, pep in sorted(bounds, reverse=True):
            if bound < best[0]:
                break
            matcher.set_seq1(pep)
            if (matcher.ratio(), k) > best:
                best = matcher.ratio(), k
                blocks = [m for m in matcher.get_matching_blocks() if m.size]
                at = blocks[0].a if blocks else 0
                size = blocks[-1].a + blocks[-1].size - at if blocks else 0
        out.append((held, best[0], -best[1], at, size))
    return pd.DataFrame(out, columns=["own", "ratio", "place", "at", "size"])


def best_frames(hits: DataFrame, most_shift: int = 2, least: float = 0.5) -> DataFrame:
    """(hit_id, pep, match_start, match_end): the reading of each hit (hit_id, template, seq, match_start, match_end) most like its template.

    Bounds are 0-based and half open. The hit as it is stays if its peptide equals the template, or is alike by more
    than ``least`` without a stop. Else both ends are shifted; of the most alike the least shift of the start, then of
    the end, counts. A longer peptide with a stop is cut to the stretch that matches if that is as long as the
    template. The peptide is empty where a stop is left, where nothing is alike, or where a hit ends with its sequence
    or behind it; in the last two cases the bounds stay. Null texts count as empty, hit_id is a key.
    """
    text = hits.select("hit_id", "match_start", "match_end", *(F.coalesce(c, F.lit("")).alias(c) for c in ("template", "seq")))
    shifts = F.sequence(F.lit(-most_shift), F.lit(most_shift))
    read = lambda first, end: S.translate(F.substring(F.col("seq"), first + 1, F.greatest(end - first, F.lit(0))))
    # a reading is the start of the longest one from the same base
    longest = F.transform(shifts, lambda b: F.struct((F.col("match_start") + b).alias("first"), read(F.col("match_start") + b, F.col("match_end") + most_shift).alias("pep")))
    part = lambda s, end: F.substring(s["pep"], F.lit(1), F.floor(F.greatest(end - s["first"], F.lit(0)) / 3).cast("int"))
    tries = F.flatten(F.transform(longest, lambda s: F.transform(shifts, lambda e: F.struct(s["first"].alias("first"), (F.col("match_end") + e).alias("end"), part(s, F.col("match_end") + e).alias("pep")))))
    as_is = lambda t: (t["first"] == F.col("match_start")) & (t["end"] == F.col("match_end"))
    inside = lambda t: (t["first"] >= 0) & (t["first"] <= F.length("seq")) & (t["end"] >= 0) & (t["end"] <= F.length("seq"))
    # spread, as few bytes are much work here
    rows = spread(text, "hit_id").withColumns({"tries": F.filter(tries, lambda t: as_is(t) | inside(t)), "own": read(F.col("match_start"), F.col("match_end")), "over": F.col("match_end") >= F.length("seq")})
    scored = rows.withColumn("like", likeness("own", F.transform("tries", lambda t: t["pep"]), "template", F.lit(least)))
    enough = (F.col("own") == F.col("template")) | ((F.col("like.own") > least) & ~F.contains("own", F.lit("*")))
    best = scored.select("hit_id", "match_start", "match_end", "template", "own", "over", "like", enough.alias("enough"), F.get("tries", F.col("like.place")).alias("best"))
    pep = F.col("best.pep")
    trim = F.contains(pep, F.lit("*")) & (F.length(pep) > F.length("template")) & (F.col("like.size") == F.length("template"))
    start = F.col("best.first") + F.when(trim, 3 * F.col("like.at")).otherwise(0)
    cut = F.when(trim, F.substring(pep, F.col("like.at") + 1, F.col("like.size"))).otherwise(pep)
    moved = F.struct(F.when(F.contains(cut, F.lit("*")), "").otherwise(cut).alias("pep"), start.alias("match_start"), F.when(trim, start + 3 * F.col("like.size")).otherwise(F.col("best.end")).alias("match_end"))
    unmoved = lambda pep: F.struct(pep.alias("pep"), "match_start", "match_end")
    chosen = F.when(F.col("over"), unmoved(F.lit(""))).when(F.col("enough"), unmoved(F.col("own"))).when(F.col("like.ratio") < least, unmoved(F.lit(""))).otherwise(moved)
    return best.select("hit_id", chosen.alias("c")).select("hit_id", "c.*")
