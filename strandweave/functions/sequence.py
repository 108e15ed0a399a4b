"""Column functions over nucleotide and peptide sequences, all in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "TCAG"
#: Amino acids of the codons in TCAG order of the three bases; standard and vertebrate mitochondrial table.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
MITOCHONDRIAL = "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG"
CLASSES = ("ILAMGSDKHQF", "VVVVVTERRNY")  # fixed values: residues and the residue that stands for their class


def reverse_complement(dna: Column) -> Column:
    return F.reverse(F.translate(dna, "ACGTacgt", "TGCAtgca"))


def offset(phase: Column) -> Column:
    """Bases before the first whole codon; a negative phase counts as 0."""
    return (F.lit(3) - F.greatest(phase, F.lit(0))) % 3


def translate(dna: Column, start: Column | int = 0, mitochondrial: bool = False) -> Column:
    """Peptide of the whole codons from a 0-based start; a codon with another letter gives X.

    A codon's place in the table is computed from its bases, so the expression is as long for any sequence.
    """
    start = F.lit(start) if isinstance(start, int) else start
    table = F.lit(MITOCHONDRIAL if mitochondrial else STANDARD)
    digits = F.translate(F.upper(F.substring(dna, start + 1, F.length(dna))), BASES, "0123")
    codons = F.regexp_extract_all(digits, F.lit("(?s)(.{3})"), 1)
    residue = lambda c: F.when(c.rlike("^[0-3]{3}$"), F.substring(table, F.conv(c, 4, 10).cast("int") + 1, F.lit(1))).otherwise("X")
    return F.array_join(F.transform(codons, residue), "")


def retry_translation(dna: Column, phase: Column, all_frames: bool = False) -> Column:
    """Peptide of the first of three frames without an inner stop, its last stop stripped; empty if none is.

    The frames tried are phase, phase + 1 and phase + 3, the last of which equals the first; with ``all_frames``,
    phase + 2 takes its place.
    """
    shifts = (0, 1, 2) if all_frames else (0, 1, 3)
    peptides = F.array(*(F.regexp_replace(translate(dna, offset((phase + s) % 3)), r"\*$", "") for s in shifts))
    return F.coalesce(F.get(F.filter(peptides, lambda p: ~F.contains(p, F.lit("*"))), F.lit(0)), F.lit(""))


def crop(dna: Column, start: Column, end: Column) -> Column:
    """1-based closed bounds; a null bound is open, as is a start of 0 or less."""
    first = F.greatest(F.coalesce(start, F.lit(1)), F.lit(1))
    return F.substring(dna, first, F.greatest(F.coalesce(end, F.length(dna)) - first + 1, F.lit(0)))


def _pairs(a: Column, b: Column, test) -> Column:
    """How many columns of two aligned sequences meet a test."""
    hits = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when((x != "") & test(x, y), 1).otherwise(0))
    return F.aggregate(hits, F.lit(0), lambda s, x: s + x)


def identity(a: Column, b: Column) -> Column:
    """Columns with the same residue over all columns."""
    return _pairs(a, b, lambda x, y: (x == y) & (x != "-")) / F.length(a)


def similar(a: Column, b: Column) -> Column:
    """Columns whose residues are of one class."""
    return _pairs(F.translate(a, *CLASSES), F.translate(b, *CLASSES), lambda x, y: (x == y) & (x != "-"))


def common(a: Column, b: Column) -> Column:
    return _pairs(a, b, lambda x, y: (x != "-") & (y != "-"))


def ungapped_length(seq: Column) -> Column:
    return F.length(F.replace(seq, F.lit("-"), F.lit("")))


def tanimoto(a: Column, b: Column, heuristics: bool = True) -> Column:
    """Similarity of two aligned sequences; short ones inside long ones count by the part they cover."""
    s, c = similar(a, b).cast("double"), common(a, b).cast("double")
    m, n = ungapped_length(a).cast("double"), ungapped_length(b).cast("double")
    out = F.sqrt(s * s / (m * n))
    if heuristics:
        out = F.when(s > 0.9 * m, s / m).when(s > 0.9 * n, s / n).when((s >= 0.66 * c) & (0.66 * c > 4), s / c).otherwise(out)
    return F.when((m == 0) | (n == 0) | (c == 0), 0.0).otherwise(out)


def cigar(a: Column, b: Column) -> Column:
    """Run lengths of M (both), A (gap in the first) and B (gap in the second); empty for unequal or empty input."""
    states = F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == "", "").when((x == "-") & (y == "-"), "").when(x == "-", "A").when(y == "-", "B").otherwise("M")), "")
    runs = F.regexp_extract_all(states, F.lit("(M+|A+|B+)"), 1)
    text = F.array_join(F.transform(runs, lambda r: F.concat(F.length(r).cast("string"), F.substring(r, 1, 1))), "")
    return F.when((F.length(a) == F.length(b)) & (F.length(a) > 0), text).otherwise("")


def cigar_identity(line: Column) -> Column:
    """Matched over all columns, 0 for an empty line."""
    size = lambda pattern: F.aggregate(F.regexp_extract_all(line, F.lit(pattern), 1), F.lit(0), lambda s, x: s + x.cast("int"))
    every = size(r"(\d+)[MAB]")
    return F.when(every > 0, size(r"(\d+)M") / every).otherwise(0.0)


def bitmap(seq: Column) -> Column:
    """1 for a residue and 0 for a gap, packed to bytes with zero bits at the end, as hex."""
    bits = F.regexp_replace(F.regexp_replace(seq, "[^-]", "1"), "-", "0")
    bytes_ = F.regexp_extract_all(F.rpad(bits, (F.ceil(F.length(bits) / 8) * 8).cast("int"), F.lit("0")), F.lit("([01]{8})"), 1)
    return F.array_join(F.transform(bytes_, lambda x: F.lpad(F.conv(x, 2, 16), 2, "0")), "")


def thread_codons(aligned: Column, dna: Column) -> Column:
    """Three bases behind each residue and --- behind each gap; null unless the dna is three times as long."""
    letters = F.filter(F.split(aligned, ""), lambda x: x != "")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(s: Column, x: Column) -> Column:
        gap = x == "-"
        text = F.concat(s["text"], F.when(gap, "---").otherwise(F.substring(dna, s["at"] * 3 + 1, F.lit(3))))
        return F.struct((s["at"] + F.when(gap, 0).otherwise(1)).alias("at"), text.alias("text"))

    return F.when(F.length(dna) == 3 * ungapped_length(aligned), F.aggregate(letters, state, step, lambda s: s["text"]))


def close_enough(a: Column, b: Column, lengths: int = 3, mismatches: int = 2) -> Column:
    """Whether two peptides agree but for leading X, a few residues in length and a few mismatches."""
    x, y = (F.regexp_replace(s, "^X+", "") for s in (a, b))
    off = F.aggregate(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: F.when(p.isNotNull() & q.isNotNull() & (p != q), 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return (F.abs(F.length(x) - F.length(y)) <= lengths) & (off <= mismatches)


def fasta_id(header: Column) -> Column:
    """First token of a header without the mark, version cut off."""
    return F.regexp_extract(header, r"^>?([^.\s]+)", 1)


def wrapped(seq: Column, width: int) -> Column:
    return F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))


def without_double_gaps(a: Column, b: Column, keep: Column) -> Column:
    """``keep`` (one of the two) without the columns in which both have a gap."""
    cells = F.zip_with(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == "-") & (y == "-")), F.split(keep, ""), lambda gap, ch: F.when(gap, "").otherwise(ch))
    return F.array_join(cells, "")


def unfolded(ungapped: Column, line: Column, gap_letter: str) -> Column:
    """One side of an alignment from its sequence and the cigar; ``gap_letter`` is A for the first side, B for the second."""
    runs = F.regexp_extract_all(line, F.lit(r"(\d+[MAB])"), 1)
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))

    def step(s: Column, r: Column) -> Column:
        n = F.regexp_extract(r, r"(\d+)", 1).cast("int")
        gap = F.endswith(r, F.lit(gap_letter))
        piece = F.when(gap, F.repeat(F.lit("-"), n)).otherwise(F.substring(ungapped, s["at"], n))
        return F.struct((s["at"] + F.when(gap, 0).otherwise(n)).alias("at"), F.concat(s["text"], piece).alias("text"))

    return F.aggregate(runs, state, step, lambda s: s["text"])


def matched_of_shorter(line: Column, a: Column, b: Column) -> Column:
    """Matched columns over the length of the shorter sequence without gaps, 0 if that is empty."""
    m = F.aggregate(F.regexp_extract_all(line, F.lit(r"(\d+)M"), 1), F.lit(0), lambda s, x: s + x.cast("int"))
    n = F.least(ungapped_length(a), ungapped_length(b))
    return F.when(n > 0, m / n).otherwise(0.0)


def name_parts(name: Column) -> Column:
    """(species, exon_id, known, start) of ``species_exon_known_start``; the species may hold underscores."""
    part = lambda i: F.regexp_extract(name, r"^(.*)_(\d+)_(\d+)_(-?\d+)$", i)
    return F.struct(part(1).alias("species"), part(2).try_cast("long").alias("exon_id"), part(3).try_cast("int").alias("known"), part(4).try_cast("long").alias("start"))


def padded(seq: Column, start: Column, other: Column, other_start: Column) -> Column:
    """A sequence with gaps on both sides, to the frame that it shares with another."""
    left = F.greatest(start - F.least(start, other_start), F.lit(0))
    width = F.greatest(start + F.length(seq), other_start + F.length(other)) - F.least(start, other_start)
    return F.rpad(F.concat(F.repeat(F.lit("-"), left.cast("int")), seq), width.cast("int"), F.lit("-"))


def exon_spans(text: Column) -> Column:
    """[(label, first, last)] of every B...Z, 0-based half-open: label is the three letters behind B, the span what follows up to Z."""
    gaps, pieces = (F.regexp_extract_all(text, F.lit("(?s)(.*?)(B.*?Z)"), i) for i in (1, 2))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<label:string,first:int,last:int>>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["g"])
        end = start + F.length(x["p"])
        span = F.struct(F.substring(x["p"], 2, 3).alias("label"), (start + 4).alias("first"), (end - 1).alias("last"))
        return F.struct(end.alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    return F.aggregate(F.zip_with(gaps, pieces, lambda g, p: F.struct(g.alias("g"), p.alias("p"))), state, step, lambda s: s["spans"])


def flanked_codons(aligned: Column, dna: Column, left: Column, right: Column, flank: int) -> Column:
    """Threaded codons between lowercase flanks cut or padded to one length; an empty exon is all gaps."""
    n = F.length(aligned)
    inner = F.concat(F.lpad(F.lower(F.when(F.length(left) > flank, F.right(left, F.lit(flank))).otherwise(left)), flank, "-"), thread_codons(aligned, dna), F.rpad(F.lower(right), flank, "-"))
    return F.when(ungapped_length(aligned) == 0, F.repeat(F.lit("-"), (2 * flank + 3 * n).cast("int"))).otherwise(inner)


def patched(target: Column, template: Column) -> Column:
    """(text, codons): single gaps of the target's codons filled from the template unless a stop would arise; the codons filled, from 0."""
    cut = lambda s: F.regexp_extract_all(s, F.lit("(?s)(.{1,3})"), 1)

    def one(t: Column, m: Column) -> Column:
        place = F.locate("-", t)
        base = F.substring(m, place, F.lit(1))
        new = F.concat(F.substring(t, F.lit(1), place - 1), base, F.substring(t, place + 1, F.lit(3)))
        return F.when((F.length(t) == 3) & (F.length(t) - F.length(F.replace(t, F.lit("-"), F.lit(""))) == 1) & (base != "-") & ~translate(new).isin("*"), new).otherwise(t)

    before = cut(target)
    after = F.zip_with(before, cut(template), one)
    places = F.filter(F.transform(F.zip_with(before, after, lambda x, y: x != y), lambda d, i: F.when(d, i)), lambda i: i.isNotNull())
    return F.struct(F.array_join(after, "").alias("text"), places.alias("codons"))


def start_codon(dna: Column, joint: Column, up: int, down: int, code: str = "ATG") -> Column:
    """0-based place of the nearest start codon in steps of three upstream of a joint, else downstream; null if none."""
    places = F.concat(F.transform(F.sequence(F.lit(1), F.lit(up)), lambda i: joint - 3 * i), F.transform(F.sequence(F.lit(0), F.lit(down)), lambda i: joint + 3 * i))
    near = lambda text: F.get(F.filter(places, lambda p: (p >= 0) & (F.substring(text, (p + 1).cast("int"), F.lit(3)) == code)), F.lit(0))
    # as an item of an array the text is made once, not again for each place
    return F.get(F.transform(F.array(dna), near), F.lit(0))


def positions_of(text: Column) -> Column:
    """0-based positions of a ``start end`` range."""
    p = F.split(F.trim(text), r"\s+")
    return F.transform(F.sequence(F.get(p, F.lit(0)).cast("long"), F.get(p, F.lit(1)).cast("long")), lambda x: x - 1)


def reconstructed(exons: Column, mitochondrial: bool = False, frame: int = 0) -> Column:
    """Peptide of ordered exons [(dna, phase)]: bases behind the last codon go over to the next exon.

    Where the next exon's phase differs from what is left over, that is dropped and 3 - phase bases are skipped.
    ``frame`` bases of the first exon are left out.
    """
    state = F.struct(F.lit("").alias("carry"), F.lit("").alias("pep"), F.lit(True).alias("first"))

    def step(s: Column, x: Column) -> Column:
        own = F.when(s["first"], F.expr("''")).otherwise(s["carry"])
        fits = s["first"] | (F.length(s["carry"]) == x["phase"])
        skipped = F.when(s["first"], frame + offset(x["phase"])).otherwise(F.when(fits, 0).otherwise(offset(x["phase"])))
        dna = F.concat(F.when(fits, own).otherwise(""), F.substring(x["dna"], skipped + 1, F.length(x["dna"])))
        rest = F.length(dna) % 3
        return F.struct(F.when(rest > 0, F.right(dna, rest)).otherwise("").alias("carry"), F.concat(s["pep"], translate(dna, 0, mitochondrial)).alias("pep"), F.lit(False).alias("first"))

    return F.regexp_replace(F.aggregate(exons, state, step, lambda s: s["pep"]), r"\*$", "")


def reading_of(exons: Column, mitochondrial: bool = False) -> Column:
    """The first reading without an inner stop: as given, with the mitochondrial table, from frame 1, from frame 2; else as given."""
    tries = F.array(reconstructed(exons, mitochondrial), reconstructed(exons, True), reconstructed(exons, mitochondrial, 1), reconstructed(exons, mitochondrial, 2))
    return F.coalesce(F.get(F.filter(tries, lambda p: ~F.contains(p, F.lit("*"))), F.lit(0)), F.get(tries, F.lit(0)))


def with_selenocysteine(pep: Column, positions: Column) -> Column:
    """U at 0-based positions."""
    letters = F.filter(F.split(pep, ""), lambda x: x != "")
    return F.array_join(F.transform(letters, lambda c, i: F.when(F.array_contains(positions, i.cast("long")), "U").otherwise(c)), "")
