"""Registered queries: exon maps between genes by alignment of their exon strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import aggregates as A
from strandweave.operators import pairwise as W
from strandweave.operators import splicing as Y
from strandweave.plans.registry import _add, _ortho
from strandweave.plans.tracks import SLICES, _slices
from strandweave.session import Cut, spread


def held_slices(x: Inputs, flank: int = 15) -> DataFrame:
    """Slices with up to 60 bases on both sides, written once a query; in plans that read them again they are plain columns."""
    if "slices" not in vars(x):
        x.slices = Cut(_slices(x, 60), "slices").df
    rows = spread(x.slices, "exon_id")
    return rows.withColumns({"left_flank": F.right("left_flank", F.lit(flank)), "right_flank": F.left("right_flank", F.lit(flank))})


def _strings(x: Inputs) -> DataFrame:
    """(gene_id, decorated): the coding exons of a gene, each with the whole peptide of its own slice."""
    rows = _slices(x).withColumn("pep", S.translate(F.col("dna")))
    return A.decorated(rows.where("length(pep) > 0"))


def _both(x: Inputs, pairs: DataFrame) -> DataFrame:
    side = lambda key, text: _strings(x).select(F.col("gene_id").alias(key), F.col("decorated").alias(text))
    return pairs.distinct().join(side("a_id", "first"), "a_id").join(side("b_id", "second"), "b_id").select("a_id", "b_id", "first", "second")


def orthologue_strings(x: Inputs) -> DataFrame:
    return _both(x, _ortho(x).select(F.col("gene_id").alias("a_id"), F.col("cognate_gene_id").alias("b_id")))


def paralogue_strings(x: Inputs) -> DataFrame:
    member = x.x_hom.join(x.x_gene.select(F.col("gene_id").alias("gene_member_id"), "species_id"), "gene_member_id").join(x.x_seq.select(F.col("seq_id").alias("gene_member_id")), "gene_member_id")
    a, b = (member.select("homology_id", "species_id", F.col("gene_member_id").alias(k)) for k in ("a_id", "b_id"))
    return _both(x, a.join(b, ["homology_id", "species_id"]).where("a_id < b_id").select("a_id", "b_id"))


_add("SIM-01", lambda x: W.align(orthologue_strings(x)), None)
_add("SIM-02", lambda x: W.exon_maps(W.align(orthologue_strings(x)), 0.33333), None)
_add("SIM-03", lambda x: W.paralogue_maps(W.align(paralogue_strings(x))), None)


def _sites(x: Inputs) -> DataFrame:
    """9-mers over the ends of coding exons: three bases of the exon, six behind it."""
    return held_slices(x).select("exon_id", F.concat(F.right("dna", F.lit(3)), F.left("right_flank", F.lit(6))).alias("site")).where("length(site) = 9")


def _donor_table(x: Inputs) -> DataFrame:
    return _sites(x).groupBy(Y.donor_rest(F.col("site")).alias("word")).agg((F.count("*") / 16.0).alias("value"))


SITES = f"(SELECT exon_id, right(dna,3) || left(right_flank,6) AS site FROM {SLICES} q WHERE length(right(dna,3) || left(right_flank,6))=9)"
_LOG = lambda letter, share: "log2(CASE " + letter + " " + " ".join(f"WHEN '{c}' THEN {v / Y.BACKGROUND[c]!r}" for c, v in share.items()) + " END)"
DONOR = f"{_LOG('substr(site,4,1)', Y.DONOR[0])}+{_LOG('substr(site,5,1)', Y.DONOR[1])}"
_add("SEQ-22", lambda x: Y.donor_scores(_sites(x), _donor_table(x)).select("exon_id", F.round("score", 6).alias("score")),
     f"SELECT exon_id, round({DONOR}+log2(count(*) OVER (PARTITION BY substr(site,1,3) || substr(site,6,4))/16.0),6) AS score FROM {SITES} q")


def _acceptor_sites(x: Inputs) -> DataFrame:
    return x.x_seq.select(F.expr("substr(dna, CAST(1 + seq_id % 40 AS INT), 23)").alias("site")).where("length(site) = 23")


def _acceptor_tables(x: Inputs) -> DataFrame:
    return _acceptor_sites(x).select(F.inline(Y.acceptor_words(F.col("site")))).groupBy("part", "word").agg((F.count("*") / 8.0).alias("value"))


WORDS = " UNION ALL ".join(f"SELECT site, {k} AS part, substr(r,{at + 1},{n}) AS word FROM a" for k, (at, n) in enumerate(Y.PARTS))
_add("SEQ-22-acceptor", lambda x: Y.acceptor_scores(_acceptor_sites(x), _acceptor_tables(x)).select("site", F.round("score", 6).alias("score")),
     f"WITH a AS (SELECT site, substr(site,1,18) || substr(site,21,3) AS r FROM (SELECT substr(dna, 1+seq_id%40, 23) AS site FROM x_seq) q WHERE length(site)=23), w AS ({WORDS}), t AS (SELECT part, word, count(*)/8.0 AS value FROM w GROUP BY part, word) SELECT site, round({_LOG('substr(site,19,1)', Y.ACCEPTOR[0])}+{_LOG('substr(site,20,1)', Y.ACCEPTOR[1])}+sum(CASE WHEN part<5 THEN 1 ELSE -1 END*log2(value)),6) AS score FROM (SELECT DISTINCT site, part, word FROM w) d JOIN t USING (part, word) GROUP BY site")
_add("SEQ-23", lambda x: Y.best_donor(_slices(x).select(F.col("exon_id").alias("window_id"), F.concat(F.right("dna", F.lit(13)), "right_flank").alias("text")), _donor_table(x), -12.0).select("window_id", "shift"),
     f"WITH t AS (SELECT substr(site,1,3) || substr(site,6,4) AS word, count(*)/16.0 AS value FROM {SITES} q GROUP BY 1), w AS (SELECT exon_id, text, unnest(range(0, length(text)-8)) AS i FROM (SELECT exon_id, right(dna,13) || right_flank AS text FROM {SLICES} q) q), s AS (SELECT exon_id, i, round({DONOR}+log2(value),9) AS score FROM (SELECT exon_id, i, substr(text, CAST(i+1 AS INT), 9) AS site FROM w) q JOIN t ON t.word=substr(site,1,3) || substr(site,6,4)), b AS (SELECT *, row_number() OVER (PARTITION BY exon_id ORDER BY score DESC, i) AS rn FROM s) SELECT exon_id AS window_id, CAST(i AS INT) AS shift FROM b WHERE rn=1 AND score>=-12 AND i<>0")


def exon_templates(x: Inputs) -> DataFrame:
    return _slices(x).select(F.col("exon_id").alias("query_id"), F.col("dna").alias("seq"))


def exon_searches(x: Inputs) -> DataFrame:
    """Each exon in the sequences of its own gene and of the genes that share a homology with it."""
    own = x.x_seq.select(F.col("seq_id").alias("gene_id"))
    member = x.x_hom.join(own, F.col("gene_member_id") == F.col("gene_id")).select("homology_id", "gene_id")
    pairs = member.join(member.withColumnRenamed("gene_id", "target_id"), "homology_id").select("gene_id", "target_id").distinct()
    return _slices(x).select("gene_id", F.col("exon_id").alias("query_id")).join(pairs, "gene_id").select("query_id", "target_id")


_add("SIM-06", lambda x: Y.missing_exons(exon_templates(x), x.x_seq.select(F.col("seq_id").alias("target_id"), F.col("dna").alias("seq")), exon_searches(x)), None)


def hits(x: Inputs) -> DataFrame:
    """Coding exons between their flanks, found some bases beside their ends."""
    start = F.length("left_flank") + F.col("exon_id") % 5 - 2
    rows = held_slices(x).where("length(dna) >= 12").select(F.col("exon_id").alias("hit_id"), S.translate(F.col("dna")).alias("template"), F.concat("left_flank", "dna", "right_flank").alias("seq"),
                                                       start.cast("int").alias("match_start"), (F.length("left_flank") + F.length("dna") + F.col("exon_id") % 3 - 1).cast("int").alias("match_end"))
    return rows.where("match_start >= 0")


_add("SEQ-21", lambda x: Y.best_frames(hits(x)), None)


def acceptor_windows(x: Inputs) -> DataFrame:
    """60 bases before each coding exon and its own, looked through ten bases to both sides of the joint."""
    return held_slices(x, 60).select(F.col("exon_id").alias("window_id"), F.concat("left_flank", "dna").alias("text"), F.length("left_flank").alias("zero"), F.lit(-10).alias("low"), F.lit(10).alias("high"))


def whole_acceptor_tables(x: Inputs) -> DataFrame:
    """Sub-word counts of all 23-mers that the windows of acceptors can hold."""
    rows = acceptor_windows(x).select("text", F.explode(F.sequence(F.greatest(F.col("zero") - 30, F.lit(0)), F.least(F.col("zero") + 10, F.length("text") - 23))).alias("at")).where("at + 23 <= length(text)")
    words = rows.select(F.inline(Y.acceptor_words(F.substring(F.col("text"), F.col("at") + 1, F.lit(23)))))
    return words.groupBy("part", "word").agg((F.count("*") / 8.0).alias("value"))


def novel_exons(x: Inputs) -> DataFrame:
    """Coding exons as a search might leave them: some bases too long or too short at both ends, beside the exon itself as template."""
    rows = held_slices(x, 60).where("length(dna) >= 12 and length(left_flank) >= 6")
    whole, at = F.concat("left_flank", "dna", "right_flank"), F.length("left_flank")
    first, end = at + F.col("exon_id") % 5 - 2, at + F.length("dna") + F.col("exon_id") % 4 - 1
    cut = rows.withColumns({"whole": whole, "first": first.cast("int"), "end": F.least(end, F.length(whole)).cast("int")}).withColumn("own", F.expr("substr(whole, first + 1, end - first)"))
    pep = F.when(F.col("exon_id") % 2 == 0, S.translate(F.expr("substr(own, length(own) % 3 + 1)"))).otherwise(S.translate(F.col("own")))
    return cut.select("exon_id", F.expr("substr(whole, 1, first)").alias("left_flank"), F.col("own").alias("dna"), F.expr("substr(whole, end + 1)").alias("right_flank"), pep.alias("pep"), F.lit(0).alias("transl_start"), F.length("own").alias("transl_end"),
                      F.expr("substr(dna, 1, length(dna) - exon_id % 6)").alias("template_dna"), S.translate(F.col("dna")).alias("template_pep"), (F.col("exon_id") % 100 == 1).alias("is_first"), (F.col("exon_id") % 7 == 0).alias("is_mitochondrial"))


SITES23 = f"(SELECT exon_id, text, z, unnest(range(greatest(z-30,0), greatest(least(z+10,length(text)-23),-1)+1)) AS i FROM (SELECT exon_id, left60 || dna AS text, length(left60) AS z FROM {SLICES.replace('15', '60').replace('AS left_flank', 'AS left60')} q) q)"
_add("SEQ-23-acceptor", lambda x: Y.best_acceptor(acceptor_windows(x), whole_acceptor_tables(x), 3.0).select("window_id", "shift"),
     f"WITH s AS (SELECT exon_id, z, i, substr(text, CAST(i+1 AS INT), 23) AS site FROM {SITES23} q), a AS (SELECT site, substr(site,1,18) || substr(site,21,3) AS r FROM s), w AS ({WORDS}), t AS (SELECT part, word, count(*)/8.0 AS value FROM w GROUP BY part, word), "
     f"v AS (SELECT DISTINCT site, {_LOG('substr(site,19,1)', Y.ACCEPTOR[0])}+{_LOG('substr(site,20,1)', Y.ACCEPTOR[1])} AS c FROM s), x AS (SELECT site, any_value(c)+sum(CASE WHEN part<5 THEN 1 ELSE -1 END*log2(value)) AS score FROM (SELECT DISTINCT v.site, c, part, word FROM v JOIN w ON w.site=v.site) d JOIN t USING (part, word) GROUP BY site), "
     "p AS (SELECT exon_id, i+20-z AS shift, round(score,9) AS score, row_number() OVER (PARTITION BY exon_id ORDER BY i) AS k FROM s JOIN x USING (site) WHERE i+20-z BETWEEN -10 AND 9), b AS (SELECT *, row_number() OVER (PARTITION BY exon_id ORDER BY score DESC, shift) AS rn FROM p) SELECT exon_id AS window_id, CAST(shift AS INT) AS shift FROM b WHERE rn=1 AND score>=3 AND k>1")
_add("SEQ-25", lambda x: Y.cleaned_exons(novel_exons(x), whole_acceptor_tables(x), _donor_table(x)), None)
