"""Registered queries: sequence functions on annotated rows, and work on whole alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import aggregates as A
from strandweave.operators import joins as J
from strandweave.operators import pair_blocks as B
from strandweave.operators import repair as E
from strandweave.operators import tracks as T
from strandweave.plans.registry import COVER, LONG, PAIRS, PEPTIDE, TARGETS, _add, _strand, _targets
from strandweave.session import Cut



def _bare(c):
    return F.replace(c, F.lit("-"), F.lit(""))


ALIKE = f"substr(translate(a,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1)=substr(translate(b,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1) AND substr(a,p,1)<>'-'"
SCORE = f"CASE WHEN length(replace(a,'-',''))=0 OR length(replace(b,'-',''))=0 OR len(list_filter(range(1,61), lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-'))=0 THEN 0.0 ELSE sqrt(CAST(len(list_filter(range(1,61), lambda p: {ALIKE})) AS DOUBLE)*len(list_filter(range(1,61), lambda p: {ALIKE}))/(CAST(length(replace(a,'-','')) AS DOUBLE)*length(replace(b,'-','')))) END"

# sequences
_add("SEQ-04", lambda x: x.x_seq.select("seq_id", S.retry_translation(F.col("dna"), (F.col("seq_id") % 3).cast("int")).alias("pep")),
     f"WITH f AS (SELECT seq_id, k, substr(dna, 1+(3-(seq_id%3+k)%3)%3) AS dna FROM x_seq, (SELECT unnest([0,1,3]) AS k) q), t AS (SELECT seq_id, k, regexp_replace({PEPTIDE},'\\*$','') AS p FROM f) SELECT seq_id, coalesce(min_by(p, k) FILTER (WHERE NOT contains(p,'*')),'') AS pep FROM t GROUP BY seq_id")


def _slices(x: Inputs, flank: int = 15) -> DataFrame:
    """Coding exons with their slice of the gene's sequence and some bases on both sides, in reading direction."""
    rows = _strand(x).where("is_coding = 1").join(x.x_seq.select(F.col("seq_id").alias("gene_id"), F.col("dna").alias("whole")), "gene_id").where("length(whole) >= end_in_gene and start_in_gene > 0")
    cut = lambda first, n: F.expr(f"substr(whole, {first}, {n})")
    rows = rows.withColumns({"d": cut("start_in_gene", "end_in_gene - start_in_gene + 1"), "l": cut(f"greatest(start_in_gene - {flank}, 1)", f"start_in_gene - greatest(start_in_gene - {flank}, 1)"), "r": cut("end_in_gene + 1", f"{flank}")})
    minus = F.col("strand") < 0
    turned = lambda own, other: F.when(minus, S.reverse_complement(F.col(other))).otherwise(F.col(own))
    return rows.select("gene_id", "exon_id", "start_in_gene", "end_in_gene", "strand", "is_coding", "phase", turned("d", "d").alias("dna"), turned("l", "r").alias("left_flank"), turned("r", "l").alias("right_flank"))


SLICES = "(SELECT gene_id, exon_id, start_in_gene, end_in_gene, strand, phase, CASE WHEN strand<0 THEN reverse(translate(d,'ACGT','TGCA')) ELSE d END AS dna, CASE WHEN strand<0 THEN reverse(translate(r,'ACGT','TGCA')) ELSE l END AS left_flank, CASE WHEN strand<0 THEN reverse(translate(l,'ACGT','TGCA')) ELSE r END AS right_flank FROM (SELECT e.*, g.strand, substr(s.dna, start_in_gene, end_in_gene-start_in_gene+1) AS d, substr(s.dna, greatest(start_in_gene-15,1), start_in_gene-greatest(start_in_gene-15,1)) AS l, substr(s.dna, end_in_gene+1, 15) AS r FROM x_exon e JOIN x_gene g ON g.gene_id=e.gene_id JOIN x_seq s ON s.seq_id=e.gene_id WHERE is_coding=1 AND length(s.dna)>=end_in_gene AND start_in_gene>0) q)"
_add("SEQ-06", lambda x: _slices(x).select("exon_id", "phase", "dna", "left_flank", "right_flank", S.translate(F.col("dna"), S.offset(F.col("phase"))).alias("pep")),
     f"SELECT exon_id, phase, whole AS dna, left_flank, right_flank, {PEPTIDE} AS pep FROM (SELECT exon_id, phase, left_flank, right_flank, dna AS whole, substr(dna, 1+(3-phase)%3) AS dna FROM {SLICES} q) q")
BOTH = "array_to_string(list_transform(list_filter(ps, lambda p: NOT (substr(a,p,1)='-' AND substr(b,p,1)='-')), lambda p: substr({},p,1)),'')"
_add("SEQ-08", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.rows_of_pairs, "first string, second string").drop("aln_id"), f"SELECT a_id, b_id, {BOTH.format('a')} AS first, {BOTH.format('b')} AS second FROM {PAIRS} q")
_add("SEQ-09", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.matched_shares, "of_all double, of_shorter double").drop("aln_id"),
     f"SELECT a_id, b_id, coalesce(m/nullif(n,0),0.0) AS of_all, coalesce(m/nullif(k,0),0.0) AS of_shorter FROM (SELECT a_id, b_id, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-')) AS m, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' OR substr(b,p,1)<>'-')) AS n, least(length(replace(a,'-','')),length(replace(b,'-',''))) AS k FROM {PAIRS} q) q")
_add("SEQ-14", lambda x: x.x_exon.select(F.concat_ws("_", "logic_name", F.lit("x"), F.col("exon_id").cast("string"), F.col("is_coding").cast("string"), F.col("start_in_gene").cast("string")).alias("name")).select("name", S.name_parts(F.col("name")).alias("p")).select("name", "p.*"),
     "SELECT logic_name || '_x_' || exon_id || '_' || is_coding || '_' || start_in_gene AS name, logic_name || '_x' AS species, exon_id, is_coding AS known, start_in_gene AS start FROM x_exon")


def _framed(x: Inputs) -> DataFrame:
    rows = x.x_aln.withColumns({"a_start": (F.col("seq_id") % 5).cast("int"), "b_start": (F.col("seq_id") % 4).cast("int")})
    return B.all_pairs(rows, ["aln_id"], B.framed_rows, "first string, second string", ["a_start", "b_start"]).drop("aln_id")


_add("SEQ-15", _framed,
     f"SELECT a_id, b_id, {BOTH.format('a')} AS first, {BOTH.format('b')} AS second FROM (SELECT a_id, b_id, rpad(repeat('-', a_id%5-least(a_id%5,b_id%4)) || a, CAST(60+abs(a_id%5-b_id%4) AS INT), '-') AS a, rpad(repeat('-', b_id%4-least(a_id%5,b_id%4)) || b, CAST(60+abs(a_id%5-b_id%4) AS INT), '-') AS b, range(1,66) AS ps FROM {PAIRS} q) q")
_add("SEQ-16", lambda x: A.decorated(_strand(x).join(x.x_seq.select(F.col("seq_id").alias("gene_id"), "pep"), "gene_id")).select("gene_id", F.explode(S.exon_spans(F.col("decorated"))).alias("s")).select("gene_id", "s.*"),
     "SELECT gene_id, lpad(CAST(r AS VARCHAR),3,'0') AS label, CAST((r-1)*(n+5)+4 AS INT) AS first, CAST((r-1)*(n+5)+4+n AS INT) AS last FROM (SELECT e.gene_id, length(s.pep) AS n, row_number() OVER (PARTITION BY e.gene_id ORDER BY CASE WHEN g.strand<0 THEN -start_in_gene ELSE start_in_gene END, exon_id) AS r FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id JOIN x_seq s ON s.seq_id=e.gene_id) q")


def _threads(x: Inputs) -> DataFrame:
    rows = x.x_aln.join(x.x_seq.select("seq_id", "dna"), "seq_id")
    n = (3 * S.ungapped_length(F.col("seq"))).cast("int")
    return rows.select("aln_id", "seq_id", "seq", F.substring(F.rpad("dna", 180, "A"), F.lit(1), n).alias("dna"), F.expr("substr(dna, 1, seq_id % 20)").alias("left_flank"), F.expr("substr(dna, 30, seq_id % 17)").alias("right_flank"))


THREAD = "array_to_string(list_transform(range(1,61), lambda p: CASE WHEN substr(seq,p,1)='-' THEN '---' ELSE substr(d, 3*(length(replace(substr(seq,1,p),'-',''))-1)+1, 3) END),'')"
FULL = "(SELECT l.*, rpad(substr(dna,1,180),180,'A') AS d, substr(dna,1,l.seq_id%20) AS lf, substr(dna,30,l.seq_id%17) AS rf FROM x_aln l JOIN x_seq s ON s.seq_id=l.seq_id)"
_add("SEQ-18", lambda x: _threads(x).select("aln_id", "seq_id", S.thread_codons(F.col("seq"), F.col("dna")).alias("codons")), f"SELECT aln_id, seq_id, {THREAD} AS codons FROM {FULL} q")
_add("SEQ-19", lambda x: _threads(x).select("aln_id", "seq_id", S.flanked_codons(F.col("seq"), F.col("dna"), F.col("left_flank"), F.col("right_flank"), 12).alias("row")),
     f"SELECT aln_id, seq_id, CASE WHEN length(replace(seq,'-',''))=0 THEN repeat('-',204) ELSE lpad(lower(right(lf,12)),12,'-') || {THREAD} || rpad(lower(rf),12,'-') END AS row FROM {FULL} q")


def _patch(x: Inputs) -> DataFrame:
    rows = x.x_aln.withColumn("seq", F.translate("seq", "ARNDCQEGHILKMFPSTWYVX", "ACGTACGTACGTACGTACGTA"))
    return B.all_pairs(rows, ["aln_id"], B.patched, "patched string, codons string").drop("aln_id")


BASES = "translate({},'ARNDCQEGHILKMFPSTWYVX','ACGTACGTACGTACGTACGTA')"
_add("SEQ-20", _patch,
     f"WITH c AS (SELECT a_id, b_id, i, substr(a,3*i+1,3) AS t, substr(b,3*i+1,3) AS m FROM (SELECT a_id, b_id, {BASES.format('a')} AS a, {BASES.format('b')} AS b, unnest(range(0,20)) AS i FROM {PAIRS} q) q), n AS (SELECT *, CASE WHEN length(replace(t,'-',''))=2 AND substr(m,strpos(t,'-'),1)<>'-' THEN replace(t,'-',substr(m,greatest(strpos(t,'-'),1),1)) END AS w FROM c), k AS (SELECT *, CASE WHEN w IS NOT NULL AND w NOT IN ('TAA','TAG','TGA') THEN w END AS f FROM n) SELECT a_id, b_id, string_agg(coalesce(f,t),'' ORDER BY i) AS patched, coalesce(string_agg(CAST(i AS VARCHAR),',' ORDER BY i) FILTER (WHERE f IS NOT NULL),'') AS codons FROM k GROUP BY a_id, b_id")
_add("SEQ-24", lambda x: x.x_seq.select("seq_id", S.start_codon(F.col("dna"), (F.col("seq_id") % 60).cast("int"), 10, 30).alias("place")),
     "SELECT seq_id, CAST(list_filter(list_concat(list_transform(range(1,11), lambda i: seq_id%60-3*i), list_transform(range(0,31), lambda i: seq_id%60+3*i)), lambda p: p>=0 AND substr(dna,CAST(p+1 AS INT),3)='ATG')[1] AS INT) AS place FROM x_seq")
_add("SEQ-26", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.close_enough, "close boolean").drop("aln_id"),
     f"SELECT a_id, b_id, abs(length(a)-length(b))<=3 AND len(list_filter(range(1,least(length(a),length(b))+1), lambda p: substr(a,p,1)<>substr(b,p,1)))<=2 AS close FROM (SELECT a_id, b_id, ltrim(a,'X') AS a, ltrim(b,'X') AS b FROM {PAIRS} q) q")
_add("SEQ-27", lambda x: x.x_gene.select("gene_id", F.explode(S.positions_of(F.concat_ws(" ", (F.col("gene_id") % 50 + 1).cast("string"), (F.col("gene_id") % 50 + 1 + F.col("species_id") % 4).cast("string")))).alias("pos")), "SELECT gene_id, unnest(range(gene_id%50, gene_id%50+1+species_id%4)) AS pos FROM x_gene")
_add("SEQ-30", lambda x: A.cdna_positions(_slices(x)).select("gene_id", F.col("cdna_end").alias("position"), F.left("right_flank", F.lit(9)).alias("donor"), F.right("left_flank", F.lit(12)).alias("acceptor")),
     f"SELECT gene_id, CAST(sum(end_in_gene-start_in_gene+1) OVER (PARTITION BY gene_id ORDER BY CASE WHEN strand<0 THEN -start_in_gene ELSE start_in_gene END, exon_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS position, left(right_flank,9) AS donor, right(left_flank,12) AS acceptor FROM {SLICES} q")
_add("WIN-05", lambda x: T.split_codons(_slices(x)),
     f"SELECT exon_id, codon, {PEPTIDE.replace('dna', 'codon')} AS residue FROM (SELECT exon_id, right(t,phase) || left(dna,3-phase) AS codon FROM (SELECT *, lag(dna) OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id) AS t FROM {SLICES} q) q WHERE phase>0 AND length(t)>=phase AND length(dna)>=3-phase) q")


def reading_inputs(x: Inputs) -> DataFrame:
    """(gene_id, exons): coding slices of each gene in reading order."""
    order = F.when(F.col("strand") < 0, -F.col("start_in_gene")).otherwise(F.col("start_in_gene"))
    items = F.array_sort(F.collect_list(F.struct(order.alias("k"), "exon_id", "dna", "phase")))
    return _slices(x).groupBy("gene_id").agg(items.alias("o")).select("gene_id", F.transform("o", lambda e: F.struct(e["dna"].alias("dna"), e["phase"].alias("phase"))).alias("exons"))


_add("SEQ-33", lambda x: reading_inputs(x).select("gene_id", S.with_selenocysteine(S.reading_of(F.col("exons")), F.array(F.col("gene_id") % 50)).alias("pep")), None)

# alignments
TARGET = f"(SELECT l.aln_id, l.seq_id, l.seq AS a, r.seq AS b, range(1,61) AS ps FROM x_aln l JOIN {TARGETS} t ON t.aln_id=l.aln_id JOIN x_aln r ON r.aln_id=t.aln_id AND r.seq_id=t.target_id)"
_add("ALN-05", lambda x: T.without_dissimilar(x.x_aln, _targets(x), 0.1),
     f"SELECT aln_id, seq_id, a AS seq FROM (SELECT *, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-')) AS c, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)=substr(a,p,1))) AS s FROM {TARGET} q) q WHERE c=0 OR s/c>=0.1")
_add("ALN-08", lambda x: T.conserved_levels(x.x_aln, x.x_seq.select("seq_id", (F.col("seq_id") % 3 + 1).cast("int").alias("level")), 0.3),
     f"WITH c AS (SELECT aln_id, pos, CAST(seq_id%3+1 AS INT) AS level, substr(seq,pos,1) AS ch, count(*) AS n FROM {LONG} q GROUP BY 1,2,3,4), m AS (SELECT aln_id, pos, level, max(n)/sum(n)>=0.3 AS ok FROM c GROUP BY 1,2,3) SELECT aln_id, pos, coalesce(min(CASE WHEN NOT ok THEN level END)-1, max(level)) AS level FROM m GROUP BY 1,2")
_add("ALN-09", lambda x: T.boundaries(x.x_aln.withColumn("seq", F.translate("seq", "RST", "ZZZ"))), f"SELECT DISTINCT aln_id, pos FROM {LONG} q WHERE substr(translate(seq,'RST','ZZZ'),pos,3)='-Z-'")


def _marked_peptides(x: Inputs) -> DataFrame:
    """Aligned rows with a boundary mark at a column that changes with the sequence, and a second one in every other row."""
    at = (F.col("seq_id") % 3 * 10 + 6).cast("int")
    one = F.concat(F.substring("seq", F.lit(1), at), F.lit("-Z-"), F.substring(F.col("seq"), at + 4, F.length("seq")))
    two = F.when(F.col("seq_id") % 2 == 0, F.concat(F.substring("one", 1, 40), F.lit("-Z-"), F.expr("substring(one, 44)"))).otherwise(F.col("one"))
    return x.x_aln.withColumn("one", one).select("aln_id", "seq_id", two.alias("seq"))


def _exons_of_rows(x: Inputs) -> DataFrame:
    """For each exon of these rows as many bases of the sequence as it has residues, and ten on both sides."""
    rows = _marked_peptides(x).select("seq_id", F.posexplode(F.split("seq", "-Z-")).alias("exon_no", "pep")).join(x.x_seq.select("seq_id", F.col("dna").alias("whole")), "seq_id")
    rows = rows.withColumn("n", 3 * F.length(_bare(F.col("pep"))))
    return rows.select("seq_id", "exon_no", F.expr("substring(whole, 100 * exon_no + 11, n)").alias("dna"), F.expr("substring(whole, 100 * exon_no + 1, 10)").alias("left_flank"), F.expr("substring(whole, 100 * exon_no + 11 + n, 10)").alias("right_flank"))


ROWS_Z = "(SELECT aln_id, seq_id, CASE WHEN seq_id%2=0 THEN substr(one,1,40)||'-Z-'||substr(one,44) ELSE one END AS seq FROM (SELECT aln_id, seq_id, substr(seq,1,CAST(seq_id%3*10+6 AS INT))||'-Z-'||substr(seq,CAST(seq_id%3*10+10 AS INT)) AS one FROM x_aln) q)"
_add("ALN-18", lambda x: T.protein_to_dna(_marked_peptides(x), _exons_of_rows(x), 12),
     f"WITH m AS (SELECT * FROM {ROWS_Z} q), b AS (SELECT aln_id, list_sort(list(DISTINCT i)) AS bs FROM (SELECT aln_id, seq, unnest(range(0,60)) AS i FROM m) q WHERE substr(seq,i+1,3)='-Z-' GROUP BY aln_id), "
     "r AS (SELECT m.*, bs, list_filter(bs, lambda p: substr(seq,p+1,3)='-Z-') AS own FROM m JOIN b USING (aln_id)), "
     "e AS (SELECT *, unnest(range(0,len(own)+1)) AS k FROM r), "
     "p AS (SELECT aln_id, seq_id, k, seq, bs, CASE WHEN k=0 THEN 0 ELSE own[k]+3 END AS a, CASE WHEN k=len(own) THEN length(seq) ELSE own[k+1] END AS z FROM e), "
     "d AS (SELECT p.*, substr(seq,a+1,z-a) AS pep, list_filter(bs, lambda g: g>a-3 AND g<z) AS ins, 3*length(replace(substr(seq,a+1,z-a),'-','')) AS n, s.dna AS w FROM p LEFT JOIN x_seq s USING (seq_id)), "
     "t AS (SELECT *, CASE WHEN n=0 OR w IS NULL OR length(substr(w,100*k+11,n))<>n THEN repeat('-',CAST(24+3*length(pep) AS INT)) ELSE lpad(lower(substr(w,100*k+1,10)),12,'-') || array_to_string(list_transform(range(1,length(pep)+1), lambda i: CASE WHEN substr(pep,i,1)='-' THEN '---' ELSE substr(w,100*k+11+3*length(replace(substr(pep,1,i-1),'-','')),3) END),'') || rpad(lower(substr(w,100*k+11+n,10)),12,'-') END AS line FROM d), "
     "u AS (SELECT *, list_transform(ins, lambda g: 12+3*(g-a)) AS c FROM t), "
     "v AS (SELECT aln_id, seq_id, k, array_to_string(list_transform(range(0,len(c)+1), lambda j: substr(line, CASE WHEN j=0 THEN 1 ELSE c[j]+10 END, greatest((CASE WHEN j=len(c) THEN length(line) ELSE c[j+1] END) - (CASE WHEN j=0 THEN 0 ELSE c[j]+9 END), 0))), repeat('-',12)||'-Z-'||repeat('-',12)) AS txt FROM u) "
     "SELECT aln_id, seq_id, string_agg(txt, '-Z-' ORDER BY k) AS row FROM v GROUP BY aln_id, seq_id")


def _pieces(x: Inputs) -> DataFrame:
    k = (F.col("seq_id") % 6 * 9).cast("int")
    return x.x_aln.select("aln_id", "seq_id", F.rpad(F.concat(F.repeat(F.lit("-"), k), F.substring(F.col("seq"), k + 1, F.lit(8))), 60, "-").alias("seq"))


PIECES = "(SELECT aln_id, seq_id, rpad(repeat('-', seq_id%6*9) || substr(seq, seq_id%6*9+1, 8), 60, '-') AS seq FROM x_aln)"
_add("ALN-11", lambda x: T.settled_pieces(_pieces(x), _targets(x)),
     f"WITH p AS (SELECT q.*, len(list_filter(range(1,61), lambda i: substr(q.seq,i,1)<>'-' AND substr(q.seq,i,1)=substr(r.seq,i,1)))/60 AS sc FROM {PIECES} q JOIN {TARGETS} t ON t.aln_id=q.aln_id JOIN {PIECES} r ON r.aln_id=t.aln_id AND r.seq_id=t.target_id), l AS (SELECT DISTINCT a.aln_id, CASE WHEN a.sc<b.sc THEN a.seq_id ELSE b.seq_id END AS seq_id FROM p a JOIN p b ON a.aln_id=b.aln_id AND a.seq_id<b.seq_id WHERE len(list_filter(range(1,61), lambda i: substr(a.seq,i,1)<>'-' AND substr(b.seq,i,1)<>'-'))>0) SELECT p.aln_id, p.seq_id, row_number() OVER (PARTITION BY p.aln_id ORDER BY length(p.seq)-length(ltrim(p.seq,'-')), p.seq_id) AS piece_no FROM p ANTI JOIN l ON l.aln_id=p.aln_id AND l.seq_id=p.seq_id")
_add("ALN-13", lambda x: T.map_groups(J.covering_pairs(x.x_exon), "master", "covered"),
     f"WITH RECURSIVE e AS (SELECT master AS x, covered AS y FROM {COVER} q UNION SELECT covered, master FROM {COVER} q), r AS (SELECT x AS n, x AS c FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x=r.n) SELECT n AS exon_id, min(c) AS group_id FROM r GROUP BY n")
_add("GRA-06", lambda x: T.merged_groups(x.x_hom.select(F.col("homology_id").alias("group_id"), F.col("gene_member_id").alias("member"))),
     "WITH RECURSIVE s AS (SELECT homology_id AS g, count(*) AS n FROM x_hom GROUP BY 1), o AS (SELECT p.homology_id AS x, q.homology_id AS y, count(*) AS k FROM x_hom p JOIN x_hom q ON p.gene_member_id=q.gene_member_id AND p.homology_id<>q.homology_id GROUP BY 1,2), e AS (SELECT x, y FROM o JOIN s a ON a.g=x JOIN s b ON b.g=y WHERE k>0.5*a.n OR k>0.5*b.n), r AS (SELECT g AS n, g AS c FROM s UNION SELECT e.y, r.c FROM r JOIN e ON e.x=r.n) SELECT n AS group_id, min(c) AS merged_id FROM r GROUP BY n")


def _scaffolds(x: Inputs) -> DataFrame:
    k = F.col("seq_id")
    return x.x_aln.select("aln_id", "seq_id", (F.floor(k / 5) % 3).alias("species"), (F.floor(k / 7) % 2).alias("scaffold"), F.array(k % 7, k % 7 + 1).alias("exons"))


_add("ALN-14", lambda x: T.fused(x.x_aln, _scaffolds(x)),
     f"SELECT aln_id, a_id AS first, b_id AS second, array_to_string(list_transform(ps, lambda p: CASE WHEN substr(a,p,1)='-' THEN substr(b,p,1) ELSE substr(a,p,1) END),'') AS seq FROM {PAIRS} q WHERE (a_id//5)%3=(b_id//5)%3 AND (a_id//7)%2<>(b_id//7)%2 AND (a_id%7+1<b_id%7 OR b_id%7+1<a_id%7)")
_counted = lambda x: x.x_seq.select("seq_id", (F.col("seq_id") % 3).alias("species"), (F.col("seq_id") % 2 + 1).alias("n_exons"))
_add("ALN-15", lambda x: T.without_pseudogenes(x.x_aln, _counted(x), 0.4),
     f"WITH d AS (SELECT aln_id, CASE WHEN a_id%2=0 THEN a_id ELSE b_id END AS s FROM {PAIRS} q WHERE a_id%3=b_id%3 AND a_id%2<>b_id%2 AND {SCORE}>0.4) SELECT * FROM x_aln x WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.aln_id=x.aln_id AND d.s=x.seq_id)")
_add("ALN-16", lambda x: T.without_dubious(x.x_aln, _targets(x), _counted(x).select("seq_id", "species")),
     f"SELECT aln_id, seq_id, a AS seq FROM (SELECT *, max(sc) OVER (PARTITION BY aln_id, seq_id%3) AS best FROM (SELECT *, {SCORE} AS sc FROM {TARGET} q) q) q WHERE sc>=0.9*best")


def _segments(x: Inputs) -> DataFrame:
    from strandweave.operators.alignment import columns

    return columns(_pieces(x)).withColumn("segment", F.floor((F.col("pos") - 1) / 6).cast("int"))


_add("ALN-17", lambda x: T.without_ghosts(_segments(x)),
     f"WITH l AS (SELECT aln_id, seq_id, pos, (pos-1)//6 AS s, substr(seq,pos,1) AS ch FROM (SELECT aln_id, seq_id, seq, CAST(unnest(range(1,61)) AS INT) AS pos FROM {PIECES} q) q), n AS (SELECT *, count(CASE WHEN ch<>'-' THEN 1 END) OVER (PARTITION BY aln_id, pos) - CASE WHEN ch<>'-' THEN 1 ELSE 0 END AS others FROM l), g AS (SELECT *, max(others) OVER (PARTITION BY aln_id, seq_id, s) AS m FROM n) SELECT aln_id, seq_id, pos, CASE WHEN m=0 THEN '-' ELSE ch END AS ch FROM g")


def _exon_rows(x: Inputs) -> DataFrame:
    return _slices(x).select("gene_id", "exon_id", "start_in_gene", "end_in_gene", S.translate(F.col("dna")).alias("pep"))


def _track_pieces(x: Inputs) -> DataFrame:
    ordinal = "CAST(row_number() OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id) - 1 AS INT)"
    return _exon_rows(x).select(F.col("gene_id").alias("track_id"), F.expr(ordinal).alias("ordinal"), "exon_id", "pep")


def _tracks(x: Inputs) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("ordinal", "pep")))
    return _track_pieces(x).groupBy("track_id").agg(items.alias("o")).select("track_id", F.array_join(F.transform("o", lambda e: F.concat(F.lit("-"), e["pep"], F.lit("-"))), "Z").alias("track"))


ROWS = f"(SELECT gene_id, exon_id, start_in_gene, end_in_gene, row_number() OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id)-1 AS n, {PEPTIDE} AS pep FROM {SLICES} q)"
_add("ALN-19", lambda x: T.piece_check(_tracks(x), _track_pieces(x).select("track_id", "ordinal", F.when(F.col("exon_id") % 3 == 0, F.reverse("pep")).otherwise(F.col("pep")).alias("pep"))),
     f"SELECT gene_id AS track_id, CAST(n AS INT) AS ordinal, exon_id%3<>0 OR pep=reverse(pep) AS equal FROM {ROWS} q WHERE length(pep)>0")
_joined = lambda x: T.concatenated(_exon_rows(x))
JOINED = f"SELECT gene_id, string_agg(pep,'Z' ORDER BY start_in_gene, exon_id) AS joined FROM (SELECT *, max(end_in_gene) OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)>=start_in_gene AS hit FROM {ROWS} q) q GROUP BY gene_id HAVING count(*)>=2 AND NOT coalesce(bool_or(hit),false)"
_add("ALN-20", lambda x: T.split_back(_joined(x)),
     f"WITH j AS ({JOINED}), p AS (SELECT r.gene_id, n, pep, length(joined) AS w, coalesce(sum(length(pep)+1) OVER (PARTITION BY r.gene_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS before FROM {ROWS} r JOIN j ON j.gene_id=r.gene_id) SELECT gene_id, CAST(n AS INT) AS ordinal, repeat('-', CAST(before AS INT)) || pep || repeat('-', CAST(w-before-length(pep) AS INT)) AS row FROM p")
_add("ALN-21", lambda x: T.rebuilt_rows(x.x_aln.select("aln_id", "seq_id", F.regexp_replace(F.regexp_replace("seq", "[^-]", "1"), "-", "0").alias("mask")), x.x_aln.where("seq_id % 4 > 0").select("aln_id", "seq_id", F.replace("seq", F.lit("-"), F.lit("")).alias("pep"))),
     "SELECT * FROM x_aln WHERE seq_id%4>0 AND length(replace(seq,'-',''))>=3 AND NOT contains(seq,'X')")
_add("ALN-22", lambda x: T.assembled(_track_pieces(x).select(F.col("track_id").alias("parent"), "ordinal", F.length("pep").alias("width")), _track_pieces(x).where("exon_id % 3 > 0").select(F.col("track_id").alias("parent"), "ordinal", F.col("pep").alias("row")), _track_pieces(x).where("exon_id % 5 = 0").select(F.col("track_id").alias("parent"), "ordinal")),
     f"SELECT gene_id AS parent, string_agg(CASE WHEN exon_id%3=0 OR exon_id%5=0 THEN repeat('-',length(pep)) ELSE pep END,'-Z-' ORDER BY n) AS track FROM {ROWS} q GROUP BY gene_id")
_add("AGG-19", lambda x: T.atlas(x.x_pair.select(F.floor(F.col("cognate_exon_id") / 10).alias("parent"), F.col("exon_id").alias("ref_exon"), F.col("cognate_exon_id").alias("exon_id"))).select("parent", "ref_exon", F.array_join(F.transform("exons", lambda e: e.cast("string")), ",").alias("exons"), "n_refs"),
     "SELECT cognate_exon_id//10 AS parent, exon_id AS ref_exon, string_agg(DISTINCT CAST(cognate_exon_id AS VARCHAR),',' ORDER BY CAST(cognate_exon_id AS VARCHAR)) AS exons, count(*) OVER (PARTITION BY cognate_exon_id//10) AS n_refs FROM x_pair GROUP BY 1, 2")
_add("ALN-25", lambda x: T.template_row(x.x_aln.withColumn("name", F.concat_ws("_", F.when(F.col("seq_id") % 5 == 0, "template").otherwise("other"), F.col("seq_id").cast("string"))), "template"), "SELECT aln_id, min(seq_id) AS seq_id FROM x_aln WHERE seq_id%5=0 AND aln_id IS NOT NULL GROUP BY aln_id")
_add("ALN-23", lambda x: T.notes(x.x_exon, x.x_pair.withColumn("similarity", F.col("similarity").cast("double")), x.x_exon.where("phase = 0").select("exon_id")),
     "SELECT e.exon_id, f AS mapped_from, s AS similarity, CASE WHEN s IS NULL THEN '-' WHEN phase=0 THEN 'Y' ELSE 'N' END AS is_novel FROM x_exon e LEFT JOIN (SELECT cognate_exon_id, exon_id AS f, CAST(similarity AS DOUBLE) AS s FROM (SELECT *, row_number() OVER (PARTITION BY cognate_exon_id ORDER BY similarity DESC, exon_id) AS rn FROM x_pair) q WHERE rn=1) p ON p.cognate_exon_id=e.exon_id")


def ranked_rows(x: Inputs) -> DataFrame:
    return _marked_peptides(x).withColumn("rank", F.col("seq_id"))


def exons_to_repair(x: Inputs) -> DataFrame:
    """Exons with residues of every fourth sequence; its first two share the first two exons of the reference."""
    rows = _marked_peptides(x).where("seq_id % 4 = 1").select("aln_id", "seq_id", F.posexplode(F.split("seq", "Z")).alias("piece_no", "piece"))
    shared = F.when(F.col("piece_no") < 2, 0)
    return rows.select("aln_id", "seq_id", "piece_no", shared.alias("group_no"), F.lit(0).alias("first_ref"), F.lit(1).alias("last_ref"), _bare(F.col("piece")).alias("pep")).where("pep <> ''")


def several_pieces(x: Inputs) -> DataFrame:
    """Parts of three rows as the pieces of one sequence, a third of them apart from each other."""
    at = F.when(F.floor(F.col("seq_id") / 3) % 3 == 0, F.col("seq_id") % 3 * 20).otherwise(F.col("seq_id") % 3 * 10).cast("int")
    size = F.when(F.floor(F.col("seq_id") / 3) % 3 == 0, 20).otherwise(40).cast("int")
    part = F.rpad(F.concat(F.repeat(F.lit("-"), at), F.substring(F.col("seq"), at + 1, size)), F.length("seq"), F.lit("-"))
    return x.x_aln.select("aln_id", F.floor(F.col("seq_id") / 3).alias("seq_id"), F.lit(0).alias("group_no"), F.col("seq_id").alias("piece_no"), part.alias("seq"))


def piece_templates(x: Inputs) -> DataFrame:
    return x.x_aln.join(_targets(x).withColumnRenamed("aln_id", "of"), (F.col("aln_id") == F.col("of")) & (F.col("seq_id") == F.col("target_id"))).select("aln_id", F.lit(0).alias("group_no"), F.col("seq").alias("template"))


_add("ALN-10", lambda x: E.clean_boundaries(ranked_rows(x)), None)
_add("ALN-11-alike", lambda x: E.alike_pieces(several_pieces(x), piece_templates(x)).select("aln_id", "seq_id", "piece_no"), None)
_add("ALN-12", lambda x: E.repaired(ranked_rows(x), _targets(x), exons_to_repair(x)), None)
_add("ALN-12-paralogue", lambda x: E.repaired(ranked_rows(x), _targets(x), exons_to_repair(x), clean_slice=True), None)


def transcript_exons(x: Inputs) -> DataFrame:
    """Exons of the transcripts of genes with a sequence, 0-based and half open, written once a query."""
    if "placed_exons" not in vars(x):
        own = x.x_seq.select(F.col("seq_id").alias("gene_id"))
        rows = x.x_tr.join(own, "gene_id", "left_semi").join(x.x_exon.select("gene_id", "exon_id", "start_in_gene", "end_in_gene").join(own, "gene_id", "left_semi"), ["gene_id", "exon_id"])
        x.placed_exons = Cut(rows.select("gene_id", "transcript_id", (F.col("start_in_gene") - 1).alias("start"), F.col("end_in_gene").alias("end")), "placed-exons").df
    return x.placed_exons


def transcript_translations(x: Inputs) -> DataFrame:
    """Each transcript is read from its second base to its last but one."""
    return transcript_exons(x).groupBy("transcript_id").agg((F.min("start") + 1).alias("first"), (F.max("end") - 1).alias("last"))


_add("SEQ-28", lambda x: T.transcript_tracks(transcript_exons(x), transcript_translations(x), x.x_seq.select(F.col("seq_id").alias("gene_id"), F.col("dna").alias("seq"))), None)
