"""Work on whole alignments of genes: sequences to keep or fuse, boundaries, pieces and assembly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators import pair_blocks as B
from strandweave.operators.aggregates import pair_counts
from strandweave.operators.alignment import columns
from strandweave.operators.components import connected_components
from strandweave.session import Cut


def _same(a: Column, b: Column) -> Column:
    return S._pairs(a, b, lambda x, y: (x == y) & (x != "-"))


def _with_target(aln: DataFrame, targets: DataFrame) -> DataFrame:
    own = aln.join(targets, "aln_id").where("seq_id = target_id").select("aln_id", F.col("seq").alias("target"))
    return aln.join(own, "aln_id")


def without_dissimilar(aln: DataFrame, targets: DataFrame, least: float = 0.7) -> DataFrame:
    """Sequences alike their alignment's target where both have a residue; those without such a column stay."""
    c = S.common(F.col("seq"), F.col("target"))
    return _with_target(aln, targets).where((c == 0) | (_same(F.col("seq"), F.col("target")) / c >= least)).select("aln_id", "seq_id", "seq")


def conserved_levels(aln: DataFrame, levels: DataFrame, least: float = 0.9) -> DataFrame:
    """(aln_id, pos, level): how many levels from the inmost on each have one letter frequent enough in a column.

    ``levels`` is (seq_id, level), level from 1 with the members of inner levels left out.
    """
    counts = columns(aln).join(levels, "seq_id").groupBy("aln_id", "pos", "level", "ch").agg(F.count("*").alias("n"))
    best = counts.groupBy("aln_id", "pos", "level").agg((F.max("n") / F.sum("n") >= least).alias("ok"))
    failing = F.min(F.when(~F.col("ok"), F.col("level")))
    return best.groupBy("aln_id", "pos").agg(F.coalesce(failing - 1, F.max("level")).alias("level"))


def boundaries(aln: DataFrame, mark: str = "-Z-") -> DataFrame:
    """(aln_id, pos): 1-based places of a boundary mark in any sequence of an alignment."""
    places = F.filter(F.sequence(F.lit(1), F.length("seq")), lambda p: F.substring(F.col("seq"), p, F.lit(len(mark))) == mark)
    return aln.select("aln_id", F.explode(places).alias("pos")).distinct()


def protein_to_dna(aln: DataFrame, exons: DataFrame, flank: int, mark: str = "-Z-") -> DataFrame:
    """(aln_id, seq_id, row): aligned peptides (aln_id, seq_id, seq) as dna, with room for the boundaries of all sequences.

    A sequence's own marks part it to exons; each becomes codons between lowercase flanks (``flanked_codons``) from
    ``exons`` (seq_id, exon_no, dna, left_flank, right_flank), or gaps of the same length where there is none that fits.
    A boundary that another sequence has inside an exon takes the place of its three residues as flank gaps, mark, flank
    gaps; exons are joined by the mark. One row per alignment, its boundaries, meets the sequences.
    """
    bounds = boundaries(aln, mark).groupBy("aln_id").agg(F.array_sort(F.collect_list(F.col("pos") - 1)).alias("bounds"))
    rows = aln.select("aln_id", "seq_id", "seq").join(bounds, "aln_id", "left").withColumn("bounds", F.coalesce("bounds", F.array().cast("array<int>")))
    rows = rows.withColumn("own", F.filter("bounds", lambda p: F.substring(F.col("seq"), p + 1, F.lit(len(mark))) == mark))
    starts, ends = F.concat(F.array(F.lit(0)), F.transform("own", lambda p: p + len(mark))), F.concat("own", F.array(F.length("seq")))
    parts = rows.select("aln_id", "seq_id", "seq", "bounds", F.posexplode(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("exon_no", "x"))
    parts = parts.select("aln_id", "seq_id", "exon_no", F.col("x.a").alias("start"), F.substring("seq", F.col("x.a") + 1, F.col("x.b") - F.col("x.a")).alias("pep"), F.filter("bounds", lambda g: (g > F.col("x.a") - len(mark)) & (g < F.col("x.b"))).alias("inside"))
    gaps = F.repeat(F.lit("-"), (2 * flank + 3 * F.length("pep")).cast("int"))
    made = parts.join(exons, ["seq_id", "exon_no"], "left").withColumn("dna_row", F.coalesce(S.flanked_codons(F.col("pep"), F.col("dna"), F.col("left_flank"), F.col("right_flank"), flank), gaps))
    room = "-" * flank + mark + "-" * flank

    def step(s, g):
        at = flank + 3 * (g - F.col("start"))
        before = F.substring(F.col("dna_row"), s["at"] + 1, F.greatest(at - s["at"], F.lit(0)))
        return F.struct((at + 9).alias("at"), F.concat(s["text"], before, F.lit(room)).alias("text"))

    whole = F.aggregate("inside", F.struct(F.lit(0).alias("at"), F.lit("").alias("text")), step, lambda s: F.concat(s["text"], F.substring(F.col("dna_row"), s["at"] + 1, F.length("dna_row"))))
    texts = made.select("aln_id", "seq_id", "exon_no", whole.alias("text"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("exon_no", "text"))), lambda x: x["text"])
    return texts.groupBy("aln_id", "seq_id").agg(F.array_join(ordered, mark).alias("row"))


def settled_pieces(pieces: DataFrame, targets: DataFrame) -> DataFrame:
    """(aln_id, seq_id, piece_no): pieces that survive all their overlaps, in the order of their first residues.

    Of two pieces with a residue in one column that with the lower identity to the template goes, on a tie the second. So
    a piece goes if another one comes before it in any of its columns, and each column's first two pieces tell that.
    """
    own = _with_target(pieces, targets).select("aln_id", "seq_id", "seq", S.identity(F.col("seq"), F.col("target")).alias("score"))
    own = Cut(own, "piece-scores").df
    letters = own.select("aln_id", "seq_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.posexplode(F.split("seq", "")).alias("pos", "ch"))
    cells = letters.where("ch <> '-' and ch <> ''").select("aln_id", "pos", "seq_id", F.struct((-F.col("score")).alias("k"), "seq_id").alias("rank"))
    # the best of a column, and the best of the others for itself
    best = cells.groupBy("aln_id", "pos").agg(F.min("rank").alias("best"))
    beside = cells.join(best, ["aln_id", "pos"])
    other = beside.where("seq_id <> best.seq_id").groupBy("aln_id", "pos").agg(F.min("rank").alias("second"))
    rival = F.when(F.col("seq_id") == F.col("best.seq_id"), F.col("second")).otherwise(F.col("best"))
    lost = beside.join(other, ["aln_id", "pos"]).where(rival < F.col("rank")).select("aln_id", "seq_id").distinct()
    first = F.length("seq") - F.length(F.regexp_replace("seq", "^-+", ""))
    left = own.join(lost, ["aln_id", "seq_id"], "left_anti")
    return left.select("aln_id", "seq_id", F.row_number().over(Window.partitionBy("aln_id").orderBy(first, "seq_id")).alias("piece_no"))


def map_groups(maps: DataFrame, left: str, right: str) -> DataFrame:
    """(exon_id, group_id): exons that share references, straight or through others."""
    return connected_components(maps, left, right).toDF("exon_id", "group_id")


def merged_groups(members: DataFrame, share: float = 0.5) -> DataFrame:
    """(group_id, merged_id): groups (group_id, member) joined where their overlap is over a share of either one.

    Overlaps are counted by an equi join on members, and groups meet by connected components.
    """
    members = Cut(members, "group-members").df
    sizes = members.groupBy("group_id").agg(F.count("*").alias("n"))
    sized = members.join(sizes, "group_id")
    a, b = (sized.select(F.col("group_id").alias(g), F.col("n").alias(f"n{g}"), "member") for g in ("a", "b"))
    near = pair_counts(a, b, "member", "k").where((F.col("k") > share * F.col("na")) | (F.col("k") > share * F.col("nb")))
    joined = connected_components(near.select("a", "b"), "a", "b").toDF("group_id", "merged")
    return sizes.select("group_id").join(joined, "group_id", "left").select("group_id", F.coalesce("merged", "group_id").alias("merged_id"))


def fused(aln: DataFrame, pieces: DataFrame) -> DataFrame:
    """(aln_id, first, second, seq): two sequences of a species on different scaffolds whose exons follow each other, as one.

    ``pieces`` is (aln_id, seq_id, species, scaffold, exons), exons an array of reference ordinals.
    """
    both = aln.join(pieces, ["aln_id", "seq_id"]).where("scaffold is not null and size(exons) > 0").where(F.forall("exons", lambda e: e.isNotNull()))

    def follow(block: B.Block, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        scaffold, low, high = (block.column(c) for c in ("scaffold", "low", "high"))
        return (scaffold[a] != scaffold[b]) & ((high[a] < low[b]) | (high[b] < low[a]))

    rows = both.withColumns({"low": F.array_min("exons"), "high": F.array_max("exons")})
    made = B.all_pairs(rows, ["aln_id", "species"], B.fused, "seq string", ["scaffold", "low", "high"], follow)
    return made.select("aln_id", F.col("a_id").alias("first"), F.col("b_id").alias("second"), "seq")


def without_pseudogenes(aln: DataFrame, exon_numbers: DataFrame, most: float = 0.9) -> DataFrame:
    """Sequences but those of one exon that are too like one of several exons; ``exon_numbers`` is (seq_id, species, n_exons)."""
    own = aln.join(exon_numbers, "seq_id")
    one = own.where("n_exons = 1").select("aln_id", "species", "seq_id", F.col("seq").alias("a"))
    many = own.where("n_exons > 1").select("aln_id", "species", F.col("seq").alias("b"))
    copies = one.join(many, ["aln_id", "species"]).where(S.tanimoto(F.col("a"), F.col("b"), heuristics=False) > most).select("aln_id", "seq_id").distinct()
    return aln.join(copies, ["aln_id", "seq_id"], "left_anti")


def without_dubious(aln: DataFrame, targets: DataFrame, species: DataFrame, share: float = 0.9) -> DataFrame:
    """Of the sequences of a species those nearly as like the target as the best one; ``species`` is (seq_id, species)."""
    scored = _with_target(aln, targets).join(species, "seq_id").withColumn("score", S.tanimoto(F.col("seq"), F.col("target"), heuristics=False))
    best = scored.withColumn("best", F.max("score").over(Window.partitionBy("aln_id", "species")))
    return best.where(F.col("score") >= share * F.col("best")).select("aln_id", "seq_id", "seq")


def without_ghosts(pieces: DataFrame) -> DataFrame:
    """(aln_id, seq_id, pos, ch): residues that no other sequence of the alignment has beside them, made gaps by segment.

    ``pieces`` is (aln_id, seq_id, segment, pos, ch); a segment is blanked if in all its columns others have gaps only.
    """
    filled = pieces.groupBy("aln_id", "pos").agg(F.count_if(F.col("ch") != "-").alias("n"))
    own = pieces.join(filled, ["aln_id", "pos"]).withColumn("alone", F.col("n") - F.when(F.col("ch") != "-", 1).otherwise(0) == 0)
    ghost = own.groupBy("aln_id", "seq_id", "segment").agg(F.bool_and("alone").alias("ghost"))
    return own.join(ghost, ["aln_id", "seq_id", "segment"]).select("aln_id", "seq_id", "pos", F.when(F.col("ghost"), "-").otherwise(F.col("ch")).alias("ch"))


def piece_check(tracks: DataFrame, stored: DataFrame) -> DataFrame:
    """(track_id, ordinal, equal): each non-empty piece between boundaries against the stored peptide of its exon."""
    p = tracks.select("track_id", F.posexplode(F.split("track", "Z")).alias("ordinal", "piece"))
    bare = F.replace("piece", F.lit("-"), F.lit(""))
    return p.where(F.length(bare) > 0).join(stored, ["track_id", "ordinal"], "left").select("track_id", "ordinal", F.coalesce(bare == F.col("pep"), F.lit(False)).alias("equal"))


def concatenated(exons: DataFrame, most_overlap: int = 0) -> DataFrame:
    """(gene_id, joined): peptides of the exons of a gene by start, joined by Z; genes of fewer than two or overlapping exons are left out."""
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    before = F.max("end_in_gene").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = exons.withColumn("hit", F.coalesce(before - F.col("start_in_gene") + 1 > most_overlap, F.lit(False)))
    items = F.array_sort(F.collect_list(F.struct("start_in_gene", "exon_id", "pep")))
    own = marked.groupBy("gene_id").agg(items.alias("o"), F.bool_or("hit").alias("hit"), F.count("*").alias("n"))
    return own.where("n >= 2 and not hit").select("gene_id", F.array_join(F.transform("o", lambda x: x["pep"]), "Z").alias("joined"))


def split_back(joined: DataFrame) -> DataFrame:
    """(gene_id, ordinal, row): each piece of a joined row alone, the others and the boundaries as gaps."""
    parts = F.split("joined", "Z")
    p = joined.select("gene_id", F.posexplode(parts).alias("ordinal", "piece"), parts.alias("all"))
    size = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + F.length(x) + 1)
    left, right = F.slice("all", F.lit(1), F.col("ordinal")), F.slice("all", F.col("ordinal") + 2, F.size("all"))
    return p.select("gene_id", "ordinal", F.concat(F.repeat(F.lit("-"), size(left)), "piece", F.repeat(F.lit("-"), size(right))).alias("row"))


def assembled(grid: DataFrame, rows: DataFrame, blanked: DataFrame) -> DataFrame:
    """(parent, track): per parent the row of each reference exon in order, gaps where it has none or is in a many-map.

    ``grid`` is (parent, ordinal, width), ``rows`` (parent, ordinal, row), ``blanked`` (parent, ordinal); pieces meet
    between boundaries.
    """
    cells = grid.join(rows, ["parent", "ordinal"], "left").join(blanked.select("parent", "ordinal", F.lit(1).alias("many")), ["parent", "ordinal"], "left")
    piece = F.when(F.col("many").isNull() & F.col("row").isNotNull(), F.col("row")).otherwise(F.repeat(F.lit("-"), F.col("width").cast("int")))
    items = F.array_sort(F.collect_list(F.struct("ordinal", piece.alias("piece"))))
    return cells.groupBy("parent").agg(items.alias("o")).select("parent", F.array_join(F.transform("o", lambda x: x["piece"]), "-Z-").alias("track"))


def atlas(links: DataFrame) -> DataFrame:
    """(parent, ref_exon, exons, n_refs): exons of a parent by reference exon, in order, and how many references each parent has."""
    own = links.groupBy("parent", "ref_exon").agg(F.array_sort(F.collect_set("exon_id")).alias("exons"))
    return own.withColumn("n_refs", F.count("*").over(Window.partitionBy("parent")))


def template_row(aln: DataFrame, mark: str) -> DataFrame:
    """(aln_id, seq_id): the first sequence of an alignment whose name holds a mark."""
    return aln.where(F.contains("name", F.lit(mark))).groupBy("aln_id").agg(F.min("seq_id").alias("seq_id"))


def notes(exons: DataFrame, maps: DataFrame, novel: DataFrame) -> DataFrame:
    """(exon_id, mapped_from, similarity, is_novel): one row per exon; Y or N where it has a map, - where none."""
    best = maps.groupBy(F.col("cognate_exon_id").alias("exon_id")).agg(F.max(F.struct("similarity", (-F.col("exon_id")).alias("k"))).alias("b"))
    found = exons.select("exon_id").join(best, "exon_id", "left").join(novel.select("exon_id", F.lit(1).alias("new")), "exon_id", "left")
    flag = F.when(F.col("b").isNull(), "-").when(F.col("new") == 1, "Y").otherwise("N")
    return found.select("exon_id", (-F.col("b.k")).alias("mapped_from"), F.col("b.similarity").alias("similarity"), flag.alias("is_novel"))


def split_codons(exons: DataFrame) -> DataFrame:
    """(exon_id, codon, residue) of codons cut by an intron: the bases left over before and those that complete them."""
    w = Window.partitionBy("gene_id").orderBy("start_in_gene", "exon_id")
    tail = F.lag("dna").over(w)
    rows = exons.withColumn("before", tail).where("phase > 0 and length(before) >= phase and length(dna) >= 3 - phase")
    codon = F.concat(F.right("before", F.col("phase")), F.left("dna", 3 - F.col("phase")))
    return rows.select("exon_id", codon.alias("codon"), S.translate(codon).alias("residue"))


def rebuilt_rows(bits: DataFrame, peptides: DataFrame) -> DataFrame:
    """(aln_id, seq_id, seq): gapped rows from gap masks of 0 and 1 and the peptides; rows whose lengths disagree are left out."""
    rows = bits.join(peptides, ["aln_id", "seq_id"]).where(F.length(F.replace("mask", F.lit("0"), F.lit(""))) == F.length("pep")).where((F.length("pep") >= 3) & ~F.contains("pep", F.lit("X")))
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))
    step = lambda s, b: F.struct((s["at"] + b.cast("int")).alias("at"), F.concat(s["text"], F.when(b == "0", "-").otherwise(F.substring(F.col("pep"), s["at"], F.lit(1)))).alias("text"))
    letters = F.filter(F.split("mask", ""), lambda x: x != "")
    return rows.select("aln_id", "seq_id", F.aggregate(letters, state, step, lambda s: s["text"]).alias("seq"))


def transcript_tracks(exons: DataFrame, translations: DataFrame, genes: DataFrame, flank: int = 10, mark: str = "-Z-") -> DataFrame:
    """(gene_id, transcript_id, dna, pep): the transcripts of a gene laid out on its sequence, one under another.

    ``exons`` is (gene_id, transcript_id, start, end), ``translations`` (transcript_id, first, last), ``genes`` (gene_id,
    seq); places are 0-based and half open. Exons are upper case, up to ``flank`` bases on both sides lower case, all
    else gaps; what no transcript of the gene shows is left out. Where the flanks of any transcript begin or end, those
    that begin or end there have the mark and the others gaps of its width; flanks cut by the sequence's ends have none.
    ``pep`` has each residue over the middle base of its codon, read along the exons inside the translation.

    The gene is cut where an exon, a flank or a translation of any transcript begins or ends. Cuts are numbered, so an
    exon reaches its stretches by their numbers and the rows are those that are shown. Exons of a transcript that overlap
    count once; exons beyond the sequence are cut off; transcripts without exons or sequence are left out.
    """
    size = F.col("size")
    own = exons.join(genes.select("gene_id", F.length("seq").alias("size")), "gene_id").where("start < end and start >= 0").where(F.col("start") < size)
    own = own.select("gene_id", "transcript_id", F.col("start").cast("int").alias("start"), F.least("end", size).cast("int").alias("end"), "size")
    own = Cut(own.withColumns({"a": F.greatest(F.col("start") - flank, F.lit(0)), "z": F.least(F.col("end") + flank, F.col("size")), "opens": F.col("start") >= flank, "closes": F.col("end") + flank <= F.col("size")}).distinct(), "track-exons").df
    inside = translations.join(own.groupBy("transcript_id").agg(F.first("gene_id").alias("gene_id"), F.first("size").alias("size")), "transcript_id")
    inside = inside.select("gene_id", "transcript_id", *(F.greatest(F.least(c, "size"), F.lit(0)).cast("int").alias(c) for c in ("first", "last"))).where("first < last")
    places = own.select("gene_id", F.explode(F.array("a", "start", "end", "z")).alias("at")).unionByName(inside.select("gene_id", F.explode(F.array("first", "last")).alias("at"))).distinct()
    w = Window.partitionBy("gene_id").orderBy("at")
    cuts = Cut(places.select("gene_id", "at", F.row_number().over(w).alias("no"), (F.lead("at").over(w) - F.col("at")).alias("n")), "track-cuts").df
    numbered = lambda rows, place, name: rows.join(cuts.select("gene_id", F.col("at").alias(place), F.col("no").alias(name)), ["gene_id", place])
    spans = own
    for place, name in (("a", "no_a"), ("start", "no_start"), ("end", "no_end"), ("z", "no_z")):
        spans = numbered(spans, place, name)
    stretch = F.transform(F.sequence(F.col("no_a"), F.col("no_z") - 1), lambda k: F.struct(k.alias("no"), ((k >= F.col("no_start")) & (k < F.col("no_end"))).cast("int").alias("exon")))
    shown = spans.where("a < z").select("gene_id", "transcript_id", F.explode(stretch).alias("x")).groupBy("gene_id", "transcript_id", F.col("x.no").alias("no")).agg(F.max("x.exon").alias("exon"))
    # a sequence meets its cuts as one row, as a join that repeats it may also make it again for each of them
    listed = cuts.groupBy("gene_id").agg(F.collect_list(F.struct("no", "at", "n")).alias("cuts")).join(genes, "gene_id")
    pieces = F.transform("cuts", lambda c: F.struct(c["no"].alias("no"), c["at"].alias("at"), c["n"].alias("n"), F.substring(F.col("seq"), c["at"] + 1, c["n"]).alias("text")))
    texts = listed.select("gene_id", F.inline(pieces))
    rows = shown.join(texts, ["gene_id", "no"]).join(inside.select("transcript_id", "first", "last"), "transcript_id", "left")
    coding = F.coalesce((F.col("exon") == 1) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("last")), F.lit(False))
    along = Window.partitionBy("gene_id", "transcript_id").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("coding", coding).withColumn("before", F.coalesce(F.sum(F.when(F.col("coding"), F.col("n")).otherwise(0)).over(along), F.lit(0)))
    part = F.struct("no", F.when(F.col("exon") == 1, F.upper("text")).otherwise(F.lower("text")).alias("dna"), "coding", "before", "n")
    tracks = rows.groupBy("gene_id", "transcript_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    read = S.translate(F.array_join(F.transform(F.filter("parts", lambda x: x["coding"]), lambda x: x["dna"]), ""))
    tracks = tracks.withColumn("padded", F.regexp_replace(read, "(.)", "-$1-")).withColumn("by_no", F.map_from_entries(F.transform("parts", lambda x: F.struct(x["no"], x))))
    ends = own.select("gene_id", "transcript_id", F.explode(F.array_compact(F.array(F.when(F.col("opens"), F.col("a")), F.when(F.col("closes"), F.col("z"))))).alias("at"))
    ends = numbered(ends, "at", "no").select("gene_id", "transcript_id", "no").distinct()
    marks = ends.groupBy("gene_id", "transcript_id").agg(F.collect_set("no").alias("own_marks"))
    anywhere = ends.select("gene_id", "no").distinct().withColumn("marked", F.lit(True))
    width = shown.select("gene_id", "no").distinct().withColumn("covered", F.lit(True))
    layout = cuts.join(width, ["gene_id", "no"], "left").join(anywhere, ["gene_id", "no"], "left").where("covered or marked")
    layout = layout.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct("no", F.when(F.col("covered"), F.col("n")).otherwise(0).alias("n"), F.coalesce("marked", F.lit(False)).alias("marked")))).alias("layout"))
    whole = tracks.join(layout, "gene_id").join(marks, ["gene_id", "transcript_id"], "left").withColumn("own_marks", F.coalesce("own_marks", F.array().cast("array<int>")))
    gaps = lambda n: F.repeat(F.lit("-"), n)
    bound = lambda x: F.when(x["marked"], F.when(F.array_contains("own_marks", x["no"]), mark).otherwise("-" * len(mark))).otherwise("")
    held = lambda x: F.try_element_at("by_no", x["no"])
    dna = lambda x: F.coalesce(held(x)["dna"], gaps(x["n"]))
    pep = lambda x: F.when(held(x)["coding"], F.rpad(F.substring(F.col("padded"), (held(x)["before"] + 1).cast("int"), x["n"]), x["n"], F.lit("-"))).otherwise(gaps(x["n"]))
    line = lambda text: F.array_join(F.transform("layout", lambda x: F.concat(bound(x), text(x))), "")
    return whole.select("gene_id", "transcript_id", line(dna).alias("dna"), line(pep).alias("pep"))
