"""The registered queries by operator id, each over the driver's tables, and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.adapters import Inputs, with_views
from strandweave.functions import sequence as S
from strandweave.operators import aggregates as A
from strandweave.operators import alignment as L
from strandweave.operators import filters as P
from strandweave.operators import graph as G
from strandweave.operators import joins as J
from strandweave.operators import lookups as K
from strandweave.operators import pair_blocks as B
from strandweave.sources import files as R

FLAGSHIP = "AGG-03"
_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _add(name: str, build: Callable[[Inputs], DataFrame], sql: str | None) -> None:
    """Registers a query; without SQL, where none can express it, a test compares it with brute force."""
    _QUERIES[name] = build
    if sql is not None:
        _SQL[name] = sql


def _exon_peptides(x: Inputs) -> DataFrame:
    """A peptide for a third of the exons: exon n of gene g has the sequence of number g."""
    return x.x_seq.select((F.col("seq_id") * 100 + 1).alias("exon_id"), "pep")


EXON_PEP = "(SELECT seq_id*100+1 AS exon_id, pep FROM x_seq)"


def _strand(x: Inputs) -> DataFrame:
    return x.x_exon.join(x.x_gene.select("gene_id", "strand"), "gene_id")


def _marked(x: Inputs) -> DataFrame:
    return J.mark_canonical(_strand(x), x.x_tr, x.x_tl)


MARKED = """(SELECT e.gene_id, e.exon_id, e.start_in_gene, e.end_in_gene, e.is_coding, CASE WHEN c.exon_id IS NULL THEN 0 ELSE 1 END AS in_canonical,
 CASE WHEN g.strand>0 AND e.exon_id=t.start_exon_id THEN e.start_in_gene+t.seq_start-1 WHEN g.strand<0 AND e.exon_id=t.end_exon_id THEN e.end_in_gene-t.seq_end+1 ELSE -1 END AS canon_transl_start,
 CASE WHEN g.strand>0 AND e.exon_id=t.end_exon_id THEN e.start_in_gene+t.seq_end-1 WHEN g.strand<0 AND e.exon_id=t.start_exon_id THEN e.end_in_gene-t.seq_start+1 ELSE -1 END AS canon_transl_end
 FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id LEFT JOIN (SELECT DISTINCT gene_id, exon_id FROM x_tr WHERE is_canonical_transcript=1) c ON c.exon_id=e.exon_id AND c.gene_id=e.gene_id
 LEFT JOIN (SELECT DISTINCT r.gene_id, l.* FROM x_tr r JOIN x_tl l ON r.transcript_id=l.transcript_id WHERE r.is_canonical_transcript=1) t ON t.gene_id=e.gene_id)"""
COVER = """(SELECT gene_id, CASE WHEN m THEN x ELSE y END AS master, CASE WHEN m THEN y ELSE x END AS covered FROM (SELECT a.gene_id, a.exon_id AS x, b.exon_id AS y,
 CASE WHEN a.is_canonical<>b.is_canonical THEN a.is_canonical=1 WHEN (a.logic_name='havana')<>(b.logic_name='havana') THEN a.logic_name='havana' WHEN (a.logic_name='ensembl')<>(b.logic_name='ensembl') THEN a.logic_name='ensembl'
 WHEN (a.start_in_gene<=b.start_in_gene AND a.end_in_gene>=b.end_in_gene)<>(b.start_in_gene<=a.start_in_gene AND b.end_in_gene>=a.end_in_gene) THEN a.start_in_gene<=b.start_in_gene AND a.end_in_gene>=b.end_in_gene END AS m
 FROM x_exon a JOIN x_exon b ON a.gene_id=b.gene_id AND a.exon_id<b.exon_id WHERE a.start_in_gene<=b.end_in_gene AND b.start_in_gene<=a.end_in_gene) q WHERE m IS NOT NULL)"""
REGION = """(SELECT g.gene_id, coalesce(min(CASE WHEN g.strand>0 THEN f.start_in_gene+l.seq_start-1 ELSE z.end_in_gene-l.seq_end+1 END), any_value(g.region_end-g.region_start)) AS tr_start,
 coalesce(max(CASE WHEN g.strand>0 THEN z.start_in_gene+l.seq_end-1 ELSE f.end_in_gene-l.seq_start+1 END), 0) AS tr_end
 FROM x_gene g LEFT JOIN (SELECT DISTINCT gene_id, transcript_id FROM x_tr) r ON r.gene_id=g.gene_id LEFT JOIN x_tl l ON l.transcript_id=r.transcript_id LEFT JOIN x_exon f ON f.exon_id=l.start_exon_id LEFT JOIN x_exon z ON z.exon_id=l.end_exon_id GROUP BY g.gene_id)"""
ORTHO = """(SELECT DISTINCT a.gene_id, b.gene_id AS cognate_gene_id, b.species_id AS cognate_species, t.description FROM (SELECT h.homology_id, g.* FROM x_hom h JOIN x_gene g ON h.gene_member_id=g.gene_id) a
 JOIN (SELECT h.homology_id, g.* FROM x_hom h JOIN x_gene g ON h.gene_member_id=g.gene_id) b ON a.homology_id=b.homology_id AND a.gene_id<>b.gene_id JOIN x_homtype t ON t.homology_id=a.homology_id WHERE a.species_id=3)"""
ROUTE = "CASE WHEN description IN ('ortholog_one2one','apparent_ortholog_one2one') THEN 'orthologue' WHEN description IN ('possible_ortholog','ortholog_one2many','ortholog_many2many') THEN 'unresolved_ortho' END"


def _ortho(x: Inputs) -> DataFrame:
    return J.orthologues(x.x_hom, x.x_homtype, x.x_gene, 3)


# projections, filters
_add("FLT-01", lambda x: P.genes_by_biotype(x.x_gene, "protein_coding", x.nation.where("n_nationkey = 2").select(F.col("n_nationkey").alias("region_id"))).select("gene_id", "stable_id"),
     "SELECT gene_id, stable_id FROM x_gene WHERE biotype='protein_coding' AND region_id<>2")
_add("FLT-02", lambda x: P.admissible_names(x.nation, "n_name", ["NATION_3"], ["NATION_1"], "NATION_2", "NATION_20").select("n_name"),
     "SELECT n_name FROM nation WHERE n_name<>'NATION_3' AND NOT n_name LIKE 'NATION\\_1%' ESCAPE '\\' AND (NOT n_name LIKE 'NATION\\_2%' ESCAPE '\\' OR n_name='NATION_20')")
_add("FLT-04", lambda x: P.with_clean_peptides(P.relevant_exons(x.x_exon), _exon_peptides(x)).select("gene_id", "exon_id", "start_in_gene", "pep"),
     f"SELECT e.gene_id, e.exon_id, e.start_in_gene, replace(p.pep,'X','') AS pep FROM x_exon e JOIN {EXON_PEP} p ON e.exon_id=p.exon_id WHERE NOT (is_canonical=1 AND is_coding=0) AND length(replace(p.pep,'X',''))>0")
_add("FLT-06", lambda x: P.usable_exons(x.x_exon, _exon_peptides(x)).select("gene_id", "exon_id"),
     f"SELECT gene_id, exon_id FROM x_exon WHERE is_canonical=1 AND is_coding=1 AND exon_id IN (SELECT exon_id FROM {EXON_PEP})")
_add("FLT-10", lambda x: P.route_homologies(x.x_homtype), f"SELECT * FROM (SELECT homology_id, description, {ROUTE} AS target FROM x_homtype) q WHERE target IS NOT NULL")
_add("FLT-11", lambda x: P.effective_bounds(_marked(x)).select("gene_id", "exon_id", "eff_start", "eff_end"),
     f"SELECT gene_id, exon_id, CASE WHEN canon_transl_start<0 THEN start_in_gene ELSE canon_transl_start END AS eff_start, CASE WHEN canon_transl_end<0 THEN end_in_gene ELSE canon_transl_end END AS eff_end FROM {MARKED} q")
_add("FLT-12", lambda x: x.x_exon.join(x.x_gene, "gene_id").select("exon_id", (F.col("region_start") + F.col("start_in_gene")).alias("region_pos")),
     "SELECT e.exon_id, g.region_start+e.start_in_gene AS region_pos FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id")
_add("FLT-14", lambda x: x.orders.join(x.customer.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", P.defaulted(F.col("c_name"), F.lit("anon")).alias("symbol")),
     "SELECT o_orderkey, coalesce(nullif(c_name,''),'anon') AS symbol FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal>0) c ON o_custkey=c_custkey")
_add("FLT-15", lambda x: P.mismatching_ids(x.x_gene.select("gene_id", "species_id"), x.orders.select(F.col("o_orderkey").alias("gene_id"), (F.col("o_custkey") % 25).alias("other_species")), "gene_id", "species_id", "other_species"),
     "SELECT gene_id, species_id, o_custkey%25 AS other_species FROM x_gene JOIN orders ON gene_id=o_orderkey WHERE species_id<>o_custkey%25")
_add("FLT-17", lambda x: x.x_seq.select("seq_id", F.contains("dna", F.lit("TTT")).alias("has_run")), "SELECT seq_id, contains(dna,'TTT') AS has_run FROM x_seq")
_add("FLT-18", lambda x: x.x_seq.select("seq_id", P.inner_stop(S.translate(F.col("dna"))).alias("rejected")), "SELECT seq_id, rejected FROM (SELECT seq_id, contains(substr(p,1,greatest(length(p)-1,0)),'*') AS rejected FROM (SELECT seq_id, {PEPTIDE} AS p FROM x_seq) q) q")
_add("FLT-19", lambda x: P.with_integer_suffix(x.nation.select("n_name"), "n_name"), r"SELECT n_name, CASE WHEN regexp_matches(n_name,'_[0-9]+$') THEN regexp_replace(n_name,'_[0-9]+$','') END AS base, CASE WHEN regexp_matches(n_name,'_[0-9]+$') THEN CAST(regexp_extract(n_name,'_([0-9]+)$',1) AS BIGINT) END AS copy_no FROM nation")
_add("FLT-20", lambda x: x.x_pair.where("similarity >= 0.8").select("exon_id", "cognate_exon_id", F.col("similarity").cast("double").alias("similarity")), "SELECT exon_id, cognate_exon_id, CAST(similarity AS DOUBLE) AS similarity FROM x_pair WHERE similarity>=0.8")

# joins
_add("JOIN-01", _ortho, f"SELECT * FROM {ORTHO} q")
_add("JOIN-02", lambda x: J.homology_subset(x.x_hom, x.x_gene.where("species_id = 3").select(F.col("gene_id").alias("gene_member_id"))), "SELECT * FROM x_hom WHERE homology_id IN (SELECT homology_id FROM x_hom JOIN x_gene ON gene_member_id=gene_id WHERE species_id=3)")
_add("JOIN-03", lambda x: J.homology_descriptions(x.x_homtype.where("homology_id % 5 <> 0"), x.x_hom), "SELECT h.homology_id, h.gene_member_id, t.description FROM x_hom h LEFT JOIN (SELECT * FROM x_homtype WHERE homology_id%5<>0) t ON h.homology_id=t.homology_id")
_add("JOIN-04", lambda x: J.one_hop(_ortho(x), 5, [6, 7, 8]), f"SELECT a.gene_id, a.rep_gene_id, b.cognate_species, b.cognate_gene_id FROM (SELECT gene_id, cognate_gene_id AS rep_gene_id FROM {ORTHO} q WHERE cognate_species=5) a LEFT JOIN (SELECT gene_id, cognate_species, max(cognate_gene_id) AS cognate_gene_id FROM {ORTHO} q WHERE cognate_species IN (6,7,8) GROUP BY gene_id, cognate_species) b ON a.gene_id=b.gene_id")
_add("JOIN-05", lambda x: J.exons_of_genes(x.x_exon, x.x_tr).select("gene_id", "exon_id", "start_in_gene", "end_in_gene"), "SELECT DISTINCT e.gene_id, e.exon_id, e.start_in_gene, e.end_in_gene FROM x_exon e JOIN x_tr t ON e.gene_id=t.gene_id AND e.exon_id=t.exon_id")
_add("JOIN-06", lambda x: _marked(x).select("gene_id", "exon_id", "in_canonical", "canon_transl_start", "canon_transl_end"), f"SELECT gene_id, exon_id, in_canonical, canon_transl_start, canon_transl_end FROM {MARKED} q")
_add("JOIN-07", lambda x: J.first_source(x.x_exon, x.x_tr).select("exon_id", "source_transcript"), "SELECT e.exon_id, coalesce(t.m,0) AS source_transcript FROM x_exon e LEFT JOIN (SELECT exon_id, min(transcript_id) AS m FROM x_tr GROUP BY exon_id) t ON e.exon_id=t.exon_id")
_add("JOIN-08", lambda x: J.coding_exons(x.x_exon, A.translated_region(x.x_gene, x.x_exon, x.x_tr, x.x_tl), x.x_tr).select("exon_id", "coding"), f"SELECT e.exon_id, CASE WHEN e.start_in_gene<=r.tr_end AND r.tr_start<=e.end_in_gene THEN 1 ELSE 0 END AS coding FROM x_exon e LEFT JOIN {REGION} r ON e.gene_id=r.gene_id")
_add("JOIN-09", lambda x: J.covering_pairs(x.x_exon), f"SELECT gene_id, master, covered FROM {COVER} q")
_add("JOIN-10", lambda x: J.contained_in_genes(x.orders.select(F.col("o_orderkey").alias("feature_id"), (F.col("o_custkey") % 7).alias("region_id"), (F.col("o_orderkey") * 10000 + 100).alias("start"), (F.col("o_orderkey") * 10000 + 100 + F.col("o_custkey") * 10).alias("end")), x.x_gene, 1_000_000).select("feature_id", "gene_id"),
     "SELECT f.feature_id, g.gene_id FROM (SELECT o_orderkey AS feature_id, o_custkey%7 AS region_id, o_orderkey*10000+100 AS s, o_orderkey*10000+100+o_custkey*10 AS e FROM orders) f JOIN x_gene g ON f.region_id=g.region_id AND g.region_start<=f.s AND f.e<=g.region_end AND g.gene_id=f.feature_id")
_add("JOIN-15", lambda x: J.reliable_orthologues(P.route_homologies(_ortho(x)), x.x_gene).select("gene_id", "cognate_gene_id", "target"),
     f"WITH o AS (SELECT *, {ROUTE} AS target FROM {ORTHO} q) SELECT o.gene_id, o.cognate_gene_id, o.target FROM o JOIN x_gene g ON g.gene_id=o.cognate_gene_id AND g.biotype='protein_coding' WHERE o.target='orthologue' OR (o.target='unresolved_ortho' AND NOT EXISTS (SELECT 1 FROM o p WHERE p.target='orthologue' AND p.gene_id=o.gene_id AND p.cognate_species=o.cognate_species))")
_add("JOIN-17", lambda x: J.paralogue_pairs(x.x_hom, x.x_homtype, x.x_gene), "SELECT DISTINCT species_id, first, second FROM (SELECT h.homology_id, g.species_id, count(*) AS n, min(g.gene_id) AS first, max(g.gene_id) AS second FROM x_hom h JOIN x_homtype t ON h.homology_id=t.homology_id AND t.description='within_species_paralog' JOIN x_gene g ON g.gene_id=h.gene_member_id AND g.biotype='protein_coding' GROUP BY h.homology_id, g.species_id) q WHERE n=2")


def missing(x: Inputs) -> DataFrame:
    """Exons outside the canonical set are without a map; a third of them have been found."""
    found = F.when((F.col("is_canonical") == 0) & (F.col("exon_id") % 3 == 0), 1).otherwise(0)
    return x.x_exon.select("gene_id", "exon_id", "start_in_gene", F.col("is_canonical").alias("mapped"), found.alias("found"))


def exon_regions(x: Inputs) -> DataFrame:
    """Places of exons on their regions; some carry the other strand or another file."""
    rows = x.x_exon.join(x.x_gene.select("gene_id", "region_id", "region_start", "region_end", "strand"), "gene_id")
    start = F.when(F.col("strand") > 0, F.col("region_start") + F.col("start_in_gene")).otherwise(F.col("region_end") - F.col("end_in_gene"))
    end = F.when(F.col("strand") > 0, F.col("region_start") + F.col("end_in_gene")).otherwise(F.col("region_end") - F.col("start_in_gene"))
    return rows.select("exon_id", F.col("region_id").alias("name"), (F.col("exon_id") % 7 == 0).cast("int").alias("file"), F.when(F.col("exon_id") % 11 == 0, -F.col("strand")).otherwise(F.col("strand")).alias("strand"), start.alias("start"), end.alias("end"))


#: From the rules as stated: the neighbour beside each exon by its number in the gene, the next known one by a minimum.
MISSING = """(SELECT m.exon_id, CASE WHEN p.mapped=1 AND n.mapped=1 THEN 'both' WHEN p.mapped=1 THEN 'no_right' ELSE 'no_left' END AS neighbourhood, CASE WHEN p.mapped=1 THEN p.exon_id END AS left_bound,
 CASE WHEN p.mapped=1 AND n.mapped=1 THEN n.exon_id WHEN coalesce(p.mapped,0)=0 THEN (SELECT arg_min(k.exon_id, k.r) FROM nr k WHERE k.gene_id=m.gene_id AND k.r>m.r AND (k.mapped=1 OR k.exon_id%3=0)) END AS right_bound
 FROM nr m LEFT JOIN nr p ON p.gene_id=m.gene_id AND p.r=m.r-1 LEFT JOIN nr n ON n.gene_id=m.gene_id AND n.r=m.r+1 WHERE m.mapped=0)"""
NUMBERED = "nr AS (SELECT gene_id, exon_id, is_canonical AS mapped, row_number() OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id) AS r FROM x_exon)"
_add("JOIN-24", lambda x: J.neighbour_spans(A.missing_class(missing(x)), exon_regions(x), 500),
     f"WITH {NUMBERED}, g AS (SELECT e.exon_id, region_id AS name, CAST(exon_id%7=0 AS INT) AS file, CASE WHEN exon_id%11=0 THEN -strand ELSE strand END AS strand, CASE WHEN strand>0 THEN region_start+start_in_gene ELSE region_end-end_in_gene END AS s, CASE WHEN strand>0 THEN region_start+end_in_gene ELSE region_end-start_in_gene END AS e FROM x_exon e JOIN x_gene USING (gene_id)), "
     f"b AS (SELECT m.exon_id, p.name AS pn, p.file AS pf, p.strand AS ps, p.s AS p1, p.e AS p2, n.name AS nn, n.file AS nf, n.strand AS ns, n.s AS n1, n.e AS n2 FROM {MISSING} m LEFT JOIN g p ON p.exon_id=left_bound LEFT JOIN g n ON n.exon_id=right_bound), "
     "c AS (SELECT exon_id, nn AS name, nf AS file, ns AS strand, n1-500 AS a, n1 AS z FROM b WHERE pn IS NULL AND ns=1 UNION ALL SELECT exon_id, nn, nf, ns, n2, n2+500 FROM b WHERE pn IS NULL AND ns<>1 "
     "UNION ALL SELECT exon_id, pn, pf, ps, p2, p2+500 FROM b WHERE nn IS NULL AND ps=1 UNION ALL SELECT exon_id, pn, pf, ps, p1-500, p1 FROM b WHERE nn IS NULL AND ps<>1 "
     "UNION ALL SELECT exon_id, pn, pf, ps, p2, n1 FROM b WHERE pn=nn AND pf=nf AND ps=ns AND p2<=n1 UNION ALL SELECT exon_id, pn, pf, ps, n2, p1 FROM b WHERE pn=nn AND pf=nf AND ps=ns AND p2>n1) "
     "SELECT exon_id, name, file, strand, greatest(a,1) AS span_start, z AS span_end FROM c")

# aggregations
_add("AGG-01", lambda x: A.group_representatives(x.x_gene, x.nation.select(F.col("n_nationkey").alias("species_id"), F.col("n_regionkey").alias("group_id"))), "SELECT group_id, min(CASE WHEN r=1 THEN species_id END) AS representative, coalesce(string_agg(CASE WHEN r>1 THEN CAST(species_id AS VARCHAR) END, ',' ORDER BY r),'') AS members FROM (SELECT n_regionkey AS group_id, species_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY count(*) DESC, species_id) AS r FROM x_gene JOIN nation ON species_id=n_nationkey GROUP BY n_regionkey, species_id) q GROUP BY group_id")
_add("AGG-02", lambda x: A.translated_region(x.x_gene, x.x_exon, x.x_tr, x.x_tl), f"SELECT * FROM {REGION} q")
_add("AGG-03", lambda x: A.reading_frames(P.effective_bounds(_marked(x))), f"SELECT gene_id, n AS coding_length, ((n%3)+3)%3 AS remainder FROM (SELECT gene_id, CAST(sum(CASE WHEN is_coding=1 THEN CASE WHEN canon_transl_end<0 THEN end_in_gene ELSE canon_transl_end END - CASE WHEN canon_transl_start<0 THEN start_in_gene ELSE canon_transl_start END + 1 ELSE 0 END) AS BIGINT) AS n FROM {MARKED} q WHERE in_canonical=1 GROUP BY gene_id) q")
_add("AGG-05", lambda x: A.exon_counts(x.x_gene, x.x_exon), "SELECT g.gene_id, count(e.exon_id) AS n_exons, count(CASE WHEN e.is_canonical=1 THEN 1 END) AS n_canonical FROM x_gene g LEFT JOIN x_exon e ON g.gene_id=e.gene_id GROUP BY g.gene_id")
_add("AGG-06", lambda x: A.sequence_coverage(x.x_exon, _exon_peptides(x)), f"SELECT e.gene_id, count(*) AS n_canonical, count(p.exon_id) AS n_with_seq FROM x_exon e LEFT JOIN {EXON_PEP} p ON e.exon_id=p.exon_id WHERE e.is_canonical=1 GROUP BY e.gene_id")
_add("AGG-07", lambda x: A.totals_with_all(x.x_gene, x.x_pair, "species_id"), "SELECT species_id, count(*) AS n FROM (SELECT species_id FROM x_gene UNION ALL SELECT species_id FROM x_pair) q GROUP BY ROLLUP (species_id)")
_add("AGG-08", lambda x: A.histogram(_ortho(x), "gene_id"), f"SELECT n AS n_per_key, count(*) AS n_keys FROM (SELECT gene_id, count(*) AS n FROM {ORTHO} q GROUP BY gene_id) q GROUP BY n")
_add("AGG-10", lambda x: A.map_coverage(x.x_exon, x.x_pair), "SELECT gene_id, count(*) AS n_exons, count(m.exon_id) AS n_mapped, count(m.exon_id)*100.0/count(*) AS percent FROM x_exon e LEFT JOIN (SELECT DISTINCT exon_id FROM x_pair) m ON e.exon_id=m.exon_id WHERE is_canonical=1 AND is_coding=1 GROUP BY gene_id".replace("count(m.exon_id)*100.0/count(*)", "CAST(count(m.exon_id)*100.0/count(*) AS DOUBLE)"))
_add("AGG-11", lambda x: x.x_exon.join(x.x_pair, "exon_id", "left_semi").select("gene_id").distinct(), "SELECT DISTINCT gene_id FROM x_exon WHERE exon_id IN (SELECT exon_id FROM x_pair)")
_add("AGG-12", lambda x: x.x_gene.agg(F.countDistinct("species_id").alias("n_groups")), "SELECT count(DISTINCT species_id) AS n_groups FROM x_gene")
_add("AGG-17", lambda x: A.merged_problems(x.x_exon.select("gene_id", F.col("logic_name").alias("description"))), "SELECT gene_id, string_agg(d, ' | ' ORDER BY d) AS description FROM (SELECT DISTINCT gene_id, logic_name AS d FROM x_exon) q GROUP BY gene_id")
_add("AGG-18", lambda x: A.joined_list(x.x_pair, "exon_id", "cognate_exon_id", ";", "maps_to"), "SELECT exon_id, string_agg(CAST(c AS VARCHAR), ';' ORDER BY c) AS maps_to FROM (SELECT DISTINCT exon_id, cognate_exon_id AS c FROM x_pair) q GROUP BY exon_id")
_add("AGG-22", lambda x: A.duplicate_keys(x.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key")), "key"), "SELECT l_orderkey*10+l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*)>1")
_add("AGG-23", lambda x: A.table_sizes({"gene": x.x_gene, "exon": x.x_exon, "map": x.x_pair}), "SELECT 'gene' AS table_name, count(*) AS n_rows FROM x_gene UNION ALL SELECT 'exon', count(*) FROM x_exon UNION ALL SELECT 'map', count(*) FROM x_pair")

# windows
_add("WIN-01", lambda x: A.running_ids(x.x_gene.select("species_id", "gene_id"), "species_id", ["gene_id"]).withColumn("id", F.col("id").cast("long")), "SELECT species_id, gene_id, row_number() OVER (PARTITION BY species_id ORDER BY gene_id) AS id FROM x_gene")
_add("WIN-02", lambda x: A.decorated(_strand(x).join(x.x_seq.select(F.col("seq_id").alias("gene_id"), "pep"), "gene_id")),
     "SELECT gene_id, string_agg('B' || lpad(CAST(r AS VARCHAR),3,'0') || pep || 'Z', '' ORDER BY r) AS decorated FROM (SELECT e.gene_id, s.pep, row_number() OVER (PARTITION BY e.gene_id ORDER BY CASE WHEN g.strand<0 THEN -start_in_gene ELSE start_in_gene END, exon_id) AS r FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id JOIN x_seq s ON s.seq_id=e.gene_id) q GROUP BY gene_id")
_add("WIN-03", lambda x: A.neighbours(x.x_exon).select("exon_id", "prev_exon", "next_exon"), "SELECT exon_id, lag(exon_id) OVER w AS prev_exon, lead(exon_id) OVER w AS next_exon FROM x_exon WINDOW w AS (PARTITION BY gene_id ORDER BY start_in_gene, exon_id)")
_add("WIN-04", lambda x: A.cdna_positions(_strand(x).where("is_coding = 1")).select("exon_id", "cdna_start", "cdna_end"), "SELECT exon_id, CAST(coalesce(sum(n) OVER w,0)+1 AS BIGINT) AS cdna_start, CAST(coalesce(sum(n) OVER w,0)+n AS BIGINT) AS cdna_end FROM (SELECT e.*, end_in_gene-start_in_gene+1 AS n, CASE WHEN strand<0 THEN -start_in_gene ELSE start_in_gene END AS k FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id WHERE is_coding=1) q WINDOW w AS (PARTITION BY gene_id ORDER BY k, exon_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
_add("WIN-06", lambda x: A.overlaps_previous(x.x_exon), "SELECT gene_id, coalesce(max(h),0) AS overlapping FROM (SELECT gene_id, CAST(lag(end_in_gene) OVER (PARTITION BY gene_id ORDER BY start_in_gene, exon_id) > start_in_gene AS INT) AS h FROM x_exon) q GROUP BY gene_id")
_add("WIN-07", lambda x: A.species_names(x.x_gene.select("species_id", "gene_id")), "SELECT species_id, gene_id, CASE WHEN n=1 THEN 's'||species_id ELSE 's'||species_id||'_'||n END AS name FROM (SELECT species_id, gene_id, row_number() OVER (PARTITION BY species_id ORDER BY gene_id) AS n FROM x_gene) q")
_add("WIN-09", lambda x: A.missing_class(missing(x)), f"WITH {NUMBERED} SELECT * FROM {MISSING} q")

# top-k, sets
_add("TOP-02", lambda x: A.best_maps(x.x_pair, 0.33333).select("species_id", "exon_id", "cognate_exon_id"), "SELECT species_id, exon_id, cognate_exon_id FROM (SELECT *, row_number() OVER (PARTITION BY species_id, exon_id ORDER BY similarity DESC, cognate_exon_id DESC, part DESC) AS rn FROM x_pair WHERE similarity>=0.33333) q WHERE rn=1")
_add("SET-01", lambda x: A.complement(x.x_gene.where("biotype = 'protein_coding'"), [x.labels.where("quality = 1").select(F.col("doc_id").alias("gene_id")), x.labels.where("toxic = 1").select(F.col("doc_id").alias("gene_id"))]), "SELECT DISTINCT gene_id FROM x_gene WHERE biotype='protein_coding' AND gene_id NOT IN (SELECT doc_id FROM labels WHERE quality=1 OR toxic=1)")
_add("SET-02", lambda x: x.x_exon.join(x.x_pair.select("exon_id").unionByName(x.x_pair.select(F.col("cognate_exon_id").alias("exon_id"))).distinct(), "exon_id", "left_semi").select("gene_id").distinct(), "SELECT DISTINCT gene_id FROM x_exon WHERE exon_id IN (SELECT exon_id FROM x_pair UNION SELECT cognate_exon_id FROM x_pair)")
_add("SET-03", lambda x: x.x_tr.select("gene_id", "exon_id").distinct(), "SELECT DISTINCT gene_id, exon_id FROM x_tr")
_add("SET-04", lambda x: A.shared_sets(x.x_hom, "gene_member_id", "homology_id"), "SELECT a.gene_member_id AS a, b.gene_member_id AS b, count(*) AS n_shared FROM x_hom a JOIN x_hom b ON a.homology_id=b.homology_id AND a.gene_member_id<b.gene_member_id GROUP BY 1, 2")

# sequences
PEPTIDE = "coalesce(list_aggregate(list_transform(range(0, CAST(floor(length(dna)/3) AS BIGINT)), lambda i: substr('" + S.STANDARD + "', CAST(1+16*(strpos('TCAG', substr(dna, 3*i+1, 1))-1)+4*(strpos('TCAG', substr(dna, 3*i+2, 1))-1)+(strpos('TCAG', substr(dna, 3*i+3, 1))-1) AS INT), 1)), 'string_agg', ''), '')"
_SQL["FLT-18"] = _SQL["FLT-18"].replace("{PEPTIDE}", PEPTIDE)
PAIRS = "(SELECT a.aln_id, a.seq_id AS a_id, b.seq_id AS b_id, a.seq AS a, b.seq AS b, range(1, length(a.seq)+1) AS ps FROM x_aln a JOIN x_aln b ON a.aln_id=b.aln_id AND a.seq_id<b.seq_id)"
COUNT = lambda test: f"len(list_filter(ps, lambda p: {test}))"


_add("SEQ-01", lambda x: x.x_seq.select("seq_id", S.reverse_complement(F.col("dna")).alias("rc")), "SELECT seq_id, reverse(translate(dna,'ACGTacgt','TGCAtgca')) AS rc FROM x_seq")
_add("SEQ-02", lambda x: x.x_seq.select("seq_id", S.translate(F.col("dna")).alias("peptide")), f"SELECT seq_id, {PEPTIDE} AS peptide FROM x_seq")
_add("SEQ-03", lambda x: x.x_exon.select("exon_id", S.offset(F.col("phase")).alias("off")), "SELECT exon_id, (3-greatest(phase,0))%3 AS off FROM x_exon")
_add("SEQ-05", lambda x: x.x_seq.select("seq_id", S.crop(F.col("dna"), (F.col("seq_id") % 50).cast("int") - 5, (F.col("seq_id") % 70 + 10).cast("int")).alias("cut")), "SELECT seq_id, substr(dna, greatest(seq_id%50-5,1), greatest(seq_id%70+10-greatest(seq_id%50-5,1)+1,0)) AS cut FROM x_seq")
_add("SEQ-10", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.identity, "identity double"), f"SELECT aln_id, a_id, b_id, {COUNT(chr(39).join(['substr(a,p,1)=substr(b,p,1) AND substr(a,p,1)<>', '-', '']))}/length(a) AS identity FROM {PAIRS} q")
_add("SEQ-12", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.tanimoto(False), "tanimoto double"),
     f"SELECT aln_id, a_id, b_id, CASE WHEN m=0 OR n=0 OR c=0 THEN 0.0 ELSE sqrt(CAST(s AS DOUBLE)*s/(CAST(m AS DOUBLE)*n)) END AS tanimoto FROM (SELECT aln_id, a_id, b_id, length(replace(a,'-','')) AS m, length(replace(b,'-','')) AS n, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-')) AS c, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(translate(a,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1)=substr(translate(b,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1))) AS s FROM {PAIRS} q) q")
_add("SEQ-12-heuristics", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.tanimoto(True), "tanimoto double"),
     f"SELECT aln_id, a_id, b_id, CASE WHEN m=0 OR n=0 OR c=0 THEN 0.0 WHEN s>0.9*m THEN s/m WHEN s>0.9*n THEN s/n WHEN s>=0.66*c AND 0.66*c>4 THEN s/c ELSE sqrt(s*s/(m*n)) END AS tanimoto FROM (SELECT aln_id, a_id, b_id, CAST(length(replace(a,'-','')) AS DOUBLE) AS m, CAST(length(replace(b,'-','')) AS DOUBLE) AS n, CAST(len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-')) AS DOUBLE) AS c, CAST(len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(translate(a,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1)=substr(translate(b,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1))) AS DOUBLE) AS s FROM {PAIRS} q) q")
_add("SEQ-13", lambda x: L.length_check(x.x_aln), "SELECT aln_id, min(length(seq))=max(length(seq)) AND max(length(seq))>0 AS equal_lengths FROM x_aln GROUP BY aln_id")
_add("SEQ-17", lambda x: x.x_aln.select("aln_id", "seq_id", F.lower(S.bitmap(F.col("seq"))).alias("bits")), "SELECT aln_id, seq_id, lower(array_to_string(list_transform(range(0,8), lambda k: lpad(to_hex(CAST(list_sum(list_transform(range(0,8), lambda j: CASE WHEN substr(rpad(seq,64,'-'),CAST(8*k+j+1 AS INT),1)='-' THEN 0 ELSE CAST(power(2,7-j) AS INT) END)) AS INT)),2,'0')),'')) AS bits FROM x_aln")
_add("SEQ-31", lambda x: x.x_gene.select("gene_id", S.fasta_id(F.concat(F.lit(">"), "stable_id", F.lit(".1 note"))).alias("id")), "SELECT gene_id, stable_id AS id FROM x_gene")

# alignments
TARGETS = "(SELECT aln_id, min(seq_id) AS target_id FROM x_aln GROUP BY aln_id)"
_targets = lambda x: x.x_aln.groupBy("aln_id").agg(F.min("seq_id").alias("target_id"))
LONG = "(SELECT aln_id, seq_id, CAST(unnest(range(1,61)) AS INT) AS pos, seq FROM x_aln)"
_add("ALN-01", lambda x: L.without_common_gaps(x.x_aln), f"WITH l AS (SELECT aln_id, seq_id, pos, substr(seq,pos,1) AS ch FROM {LONG} q), k AS (SELECT aln_id, pos FROM l GROUP BY aln_id, pos HAVING bool_or(ch<>'-')) SELECT l.aln_id, l.seq_id, string_agg(l.ch,'' ORDER BY l.pos) AS seq FROM l JOIN k ON l.aln_id=k.aln_id AND l.pos=k.pos GROUP BY l.aln_id, l.seq_id")
_add("ALN-02", lambda x: L.restricted_to(x.x_aln, _targets(x)), f"WITH l AS (SELECT aln_id, seq_id, pos, substr(seq,pos,1) AS ch FROM {LONG} q), k AS (SELECT l.aln_id, l.pos FROM l JOIN {TARGETS} t ON l.aln_id=t.aln_id AND l.seq_id=t.target_id WHERE ch NOT IN ('-','.')) SELECT l.aln_id, l.seq_id, string_agg(l.ch,'' ORDER BY l.pos) AS seq FROM l JOIN k ON l.aln_id=k.aln_id AND l.pos=k.pos GROUP BY l.aln_id, l.seq_id")
_add("ALN-03", lambda x: L.without_gappy(x.x_aln), "SELECT * FROM x_aln WHERE length(regexp_replace(seq,'[^X.-]','','g'))/length(seq)<=0.33")
_add("ALN-04", lambda x: L.without_long(x.x_aln, _targets(x)), f"SELECT a.* FROM x_aln a JOIN {TARGETS} t ON a.aln_id=t.aln_id JOIN x_aln r ON r.aln_id=t.aln_id AND r.seq_id=t.target_id WHERE length(replace(a.seq,'-',''))<=1.3*length(replace(r.seq,'-',''))")
_add("ALN-06", lambda x: L.pruned(x.x_aln), f"WITH l AS (SELECT aln_id, seq_id, pos, substr(seq,pos,1) AS ch FROM {LONG} q), c AS (SELECT aln_id, pos, ch, rank() OVER (PARTITION BY aln_id, pos ORDER BY count(*) DESC) AS r FROM l GROUP BY aln_id, pos, ch), o AS (SELECT l.aln_id, l.seq_id, count(*) AS n, count(CASE WHEN r>1 THEN 1 END) AS off FROM l JOIN c ON l.aln_id=c.aln_id AND l.pos=c.pos AND l.ch=c.ch GROUP BY l.aln_id, l.seq_id) SELECT a.* FROM x_aln a JOIN o ON a.aln_id=o.aln_id AND a.seq_id=o.seq_id WHERE off/n<0.6")
_add("ALN-07", lambda x: L.majority(x.x_aln, 0.5), f"WITH c AS (SELECT aln_id, pos, substr(seq,pos,1) AS ch, count(*) AS n FROM {LONG} q GROUP BY 1,2,3), t AS (SELECT *, max(n) OVER w AS best, sum(n) OVER w AS total, count(*) OVER (PARTITION BY aln_id, pos, n) AS k FROM c WINDOW w AS (PARTITION BY aln_id, pos)) SELECT aln_id, pos, ch FROM t WHERE n=best AND k=1 AND n/total>=0.5")
_add("ALN-24", lambda x: L.first_residues(x.x_aln), "SELECT aln_id, seq_id, f AS first_pos, CAST(row_number() OVER (PARTITION BY aln_id ORDER BY f, seq_id) AS INT) AS piece_no FROM (SELECT aln_id, seq_id, CAST(CASE WHEN length(replace(seq,'-',''))=0 THEN 0 ELSE length(seq)-length(ltrim(seq,'-'))+1 END AS INT) AS f FROM x_aln) q")

# graphs
UP = "WITH RECURSIVE up AS (SELECT node, parent AS ancestor, 1 AS distance FROM x_tree UNION ALL SELECT up.node, t.parent, distance+1 FROM up JOIN x_tree t ON up.ancestor=t.node)"
_add("GRA-01", lambda x: G.ancestors(x.x_tree), f"{UP} SELECT * FROM up")
_add("GRA-02", lambda x: G.subtree_leaves(x.x_tree), f"{UP} SELECT ancestor, count(*) AS n_leaves FROM up WHERE node NOT IN (SELECT parent FROM x_tree) GROUP BY ancestor")
_add("GRA-03", lambda x: G.by_tree_distance(x.x_tree, "c7"), f"{UP} SELECT a.node, CASE WHEN a.node='c7' THEN 0 ELSE min(b.distance) END AS steps FROM up a JOIN up b ON a.ancestor=b.ancestor AND b.node='c7' WHERE a.node NOT IN (SELECT parent FROM x_tree) GROUP BY a.node")
_add("GRA-05", lambda x: G.covering_roots(J.covering_pairs(x.x_exon)), f"WITH RECURSIVE e AS (SELECT gene_id, master, covered FROM {COVER} q), r AS (SELECT DISTINCT master AS exon_id, master AS root FROM e WHERE master NOT IN (SELECT covered FROM e) UNION SELECT e.covered, r.root FROM r JOIN e ON e.master=r.exon_id) SELECT exon_id, CASE WHEN min(root)=exon_id THEN -1 ELSE min(root) END AS root FROM r GROUP BY exon_id")
_add("GRA-05-cycles", lambda x: G.unrooted(J.covering_pairs(x.x_exon)), f"WITH RECURSIVE e AS (SELECT gene_id, master, covered FROM {COVER} q), r AS (SELECT DISTINCT master AS exon_id FROM e WHERE master NOT IN (SELECT covered FROM e) UNION SELECT e.covered FROM r JOIN e ON e.master=r.exon_id) SELECT DISTINCT gene_id, exon_id FROM (SELECT gene_id, master AS exon_id FROM e UNION ALL SELECT gene_id, covered FROM e) q WHERE exon_id NOT IN (SELECT exon_id FROM r)")
_add("GRA-07", lambda x: G.serialised(x.x_tree), "WITH n AS (SELECT parent, '(' || string_agg(node, ',' ORDER BY node) || ')' || parent AS text FROM x_tree WHERE node LIKE 'c%' GROUP BY parent), t AS (SELECT x.node, x.parent, coalesce(n.text, x.node) AS text FROM x_tree x LEFT JOIN n ON n.parent=x.node WHERE x.node LIKE 'n%'), r AS (SELECT parent, '(' || string_agg(text, ',' ORDER BY node) || ')' || parent AS text FROM t GROUP BY parent) SELECT x.node, coalesce(r.text, x.node) AS text FROM x_tree x LEFT JOIN r ON r.parent=x.node WHERE x.parent='root'")

KEPT = f"{UP}, l AS (SELECT DISTINCT node FROM x_tree WHERE node LIKE 'c%' AND CAST(substr(node,2) AS BIGINT)%7=1), m AS (SELECT node FROM l UNION SELECT ancestor FROM up WHERE node IN (SELECT node FROM l)), f AS (SELECT parent AS node FROM x_tree WHERE node IN (SELECT node FROM m) GROUP BY parent HAVING count(*)>1), k AS (SELECT node FROM l UNION SELECT node FROM f)"
_add("GRA-01-tree", lambda x: G.species_tree(x.x_tree, x.customer.where("c_custkey % 7 = 1").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"))),
     f"{KEPT} SELECT k.node, (SELECT arg_min(ancestor, distance) FROM up WHERE up.node=k.node AND ancestor IN (SELECT node FROM k)) AS parent, k.node IN (SELECT node FROM l) AS is_leaf FROM k")
_add("GRA-06-cliques", lambda x: G.paralogue_groups(J.paralogue_pairs(x.x_hom, x.x_homtype, x.x_gene).select(F.col("species_id").alias("graph"), F.col("first").alias("a"), F.col("second").alias("b"))).select("graph", "group_no", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"), "problem"), None)

# sources and sinks
_add("SRC-03", lambda x: R.fasta_text(x.x_seq.select("seq_id", "pep"), F.col("seq_id").cast("string"), F.col("pep")), r"SELECT '>' || seq_id || chr(10) || rtrim(regexp_replace(pep,'(.{50})','\1' || chr(10),'g'), chr(10)) AS value FROM x_seq")
_add("SRC-10", lambda x: R.theme_genes(x.labels.where("quality = 1").select(F.concat(F.lit("G"), F.lpad(F.col("doc_id").cast("string"), 11, "0")).alias("stable_id")), x.x_gene), "SELECT gene_id, stable_id FROM x_gene WHERE gene_id IN (SELECT doc_id FROM labels WHERE quality=1)")
_add("SRC-11", lambda x: R.insert_ignore(x.orders.where("o_orderdate < '1996-01-01'").select("o_orderkey", "o_totalprice"), x.orders.where("o_orderdate >= '1995-06-01'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")), ["o_orderkey"]), "SELECT o_orderkey, CASE WHEN o_orderdate<TIMESTAMP '1996-01-01' THEN o_totalprice ELSE o_totalprice+1 END AS o_totalprice FROM orders")
_add("SRC-12", lambda x: R.upsert(x.orders.where("o_orderdate < '1996-01-01'").select("o_orderkey", "o_totalprice"), x.orders.where("o_orderdate >= '1995-06-01'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")), ["o_orderkey"], ["o_totalprice"]), "SELECT o_orderkey, CASE WHEN o_orderdate>=TIMESTAMP '1995-06-01' THEN o_totalprice+1 ELSE o_totalprice END AS o_totalprice FROM orders")
_add("SRC-13", lambda x: R.delete_keys(x.x_pair, x.x_exon.where("is_coding = 1").select("exon_id"), ["exon_id"]).select("exon_id", "cognate_exon_id", "part"), "SELECT exon_id, cognate_exon_id, part FROM x_pair WHERE exon_id NOT IN (SELECT exon_id FROM x_exon WHERE is_coding=1)")
_add("SRC-20", lambda x: R.sharded(x.nation.select("n_nationkey"), ["n_nationkey"], 4), "SELECT n_nationkey, CAST((row_number() OVER (ORDER BY n_nationkey)-1)%4 AS INT) AS shard FROM nation")
_add("SRC-21", lambda x: R.file_mapping(x.x_gene.select("region_id").distinct(), x.nation.where("n_nationkey < 5").select(F.col("n_nationkey").cast("long").alias("region_id"), F.col("n_regionkey").alias("file_id"))), "SELECT g.region_id, coalesce(f.ids,'not found') AS file_ids FROM (SELECT DISTINCT region_id FROM x_gene) g LEFT JOIN (SELECT n_nationkey AS region_id, string_agg(CAST(n_regionkey AS VARCHAR), ',' ORDER BY n_regionkey) AS ids FROM nation WHERE n_nationkey<5 GROUP BY n_nationkey) f ON g.region_id=f.region_id")


def _ranges(x: Inputs) -> DataFrame:
    chunks = x.x_seq.select("seq_id", F.posexplode(F.regexp_extract_all("dna", F.lit("(.{1,100})"), 1)).alias("chunk_no", "seq"))
    ranges = x.x_seq.where("length(dna) >= 260").select("seq_id", F.col("seq_id").alias("range_id"), F.lit(95).alias("first"), F.lit(255).alias("last"))
    return R.extract_range(chunks, ranges, 100)


_add("SRC-24", _ranges, "SELECT seq_id AS range_id, substr(dna,95,161) AS seq FROM x_seq WHERE length(dna)>=260")

# further lookups and similarity joins
_add("FLT-05", lambda x: P.with_clean_peptides(x.x_exon.where("is_coding = 1").join(J.covering_pairs(x.x_exon).select(F.col("covered").alias("exon_id")), "exon_id", "left_anti"), _exon_peptides(x)).select("exon_id", "pep"),
     f"SELECT e.exon_id, replace(p.pep,'X','') AS pep FROM x_exon e JOIN {EXON_PEP} p ON e.exon_id=p.exon_id WHERE is_coding=1 AND length(replace(p.pep,'X',''))>0 AND e.exon_id NOT IN (SELECT covered FROM {COVER} c)")
_add("FLT-08", lambda x: K.on_region(x.x_gene, x.nation.select(F.col("n_nationkey").cast("long").alias("region_id"), F.col("n_name").alias("region_name")), "NATION_4").select("gene_id"), "SELECT gene_id FROM x_gene WHERE region_id IN (SELECT n_nationkey FROM nation WHERE n_name='NATION_4')")
_add("FLT-09", lambda x: K.by_synonym_or_description(x.customer.select(F.col("c_name").alias("name")), x.customer.where("c_custkey % 3 = 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("gene_id")), x.customer.where("c_custkey % 2 = 0").select(F.col("c_name").alias("name"), (-F.col("c_custkey")).alias("gene_id"))).where("gene_id is not null"),
     "SELECT c_name AS name, CASE WHEN c_custkey%3=0 THEN c_custkey ELSE -c_custkey END AS gene_id FROM customer WHERE c_custkey%3=0 OR c_custkey%2=0")
_add("JOIN-11", lambda x: J.overlapping_exons(x.x_exon, []).select(F.col("a_exon_id").alias("a"), F.col("b_exon_id").alias("b")),
     "SELECT a.exon_id AS a, b.exon_id AS b FROM x_exon a JOIN x_exon b ON a.gene_id=b.gene_id AND a.exon_id<b.exon_id AND NOT (b.end_in_gene<a.start_in_gene) AND NOT (a.end_in_gene<b.start_in_gene)")
_add("JOIN-13", lambda x: K.update_from(x.x_exon.select("exon_id"), x.x_seq.select((F.col("seq_id") * 100 + 1).alias("exon_id"), F.col("lang")), "exon_id", "lang").where("lang is not null"), "SELECT exon_id, lang FROM x_exon JOIN x_seq ON exon_id=seq_id*100+1 WHERE lang IS NOT NULL")
_add("JOIN-14", lambda x: K.maps_of_genes(x.x_exon, x.x_pair).select("gene_id", "exon_id", "cognate_exon_id", "part"), "SELECT e.gene_id, e.exon_id, p.cognate_exon_id, p.part FROM x_exon e JOIN x_pair p ON e.exon_id=p.exon_id")
_add("JOIN-16", lambda x: K.reverse_maps(x.x_pair), "SELECT cognate_exon_id AS exon_id, exon_id AS reference_exon_id FROM (SELECT *, row_number() OVER (PARTITION BY cognate_exon_id ORDER BY similarity DESC, exon_id, part) AS rn FROM x_pair) q WHERE rn=1")
_add("JOIN-19", lambda x: x.x_exon.select("exon_id", "gene_id").join(x.x_gene.select("gene_id", "stable_id"), "gene_id").select("exon_id", "stable_id"), "SELECT exon_id, stable_id FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id")
_add("JOIN-27", lambda x: x.x_gene.join(x.nation.select(F.col("n_nationkey").cast("long").alias("region_id"), F.col("n_name").alias("region_name")), "region_id").select("gene_id", "region_name", "region_start", "region_end", "strand"), "SELECT gene_id, n_name AS region_name, region_start, region_end, strand FROM x_gene JOIN nation ON region_id=n_nationkey")
_add("JOIN-28", lambda x: _ortho(x).where(F.col("cognate_species").isin(1, 4, 9)).select("gene_id", "cognate_gene_id").distinct(), f"SELECT DISTINCT gene_id, cognate_gene_id FROM {ORTHO} q WHERE cognate_species IN (1,4,9)")
_add("AGG-04", lambda x: K.assembled_cdna(_strand(x).where("is_coding = 1").join(x.x_seq.select(F.col("seq_id").alias("gene_id"), F.col("dna").alias("whole")), "gene_id").where("start_in_gene > 0").withColumn("dna", F.expr("substr(whole, start_in_gene, end_in_gene - start_in_gene + 1)"))),
     "SELECT gene_id, CASE WHEN min(strand)<0 THEN reverse(translate(string_agg(d,'' ORDER BY start_in_gene, exon_id),'ACGTacgt','TGCAtgca')) ELSE string_agg(d,'' ORDER BY start_in_gene, exon_id) END AS cdna FROM (SELECT e.*, g.strand, substr(s.dna, start_in_gene, end_in_gene-start_in_gene+1) AS d FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id JOIN x_seq s ON s.seq_id=e.gene_id WHERE is_coding=1 AND start_in_gene>0) q GROUP BY gene_id")
_add("AGG-13", lambda x: K.coverage(x.x_gene.select("gene_id"), x.x_exon.select("gene_id").distinct(), "gene_id"), "SELECT count(*) AS total, count(CASE WHEN gene_id NOT IN (SELECT gene_id FROM x_exon) THEN 1 END) AS without_hit FROM x_gene")
_add("TOP-01", lambda x: x.x_gene.groupBy("species_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "species_id"), "SELECT species_id, count(*) AS n FROM x_gene GROUP BY species_id ORDER BY n DESC, species_id")
_add("TOP-08", lambda x: x.x_hom.groupBy("homology_id").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "homology_id"), "SELECT homology_id, count(*) AS size FROM x_hom GROUP BY homology_id ORDER BY size DESC, homology_id")
_add("SEQ-07", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.cigars, "cigar string").drop("aln_id"),
     f"SELECT a_id, b_id, array_to_string(list_transform(regexp_extract_all(st,'M+|A+|B+'), lambda r: CAST(length(r) AS VARCHAR) || substr(r,1,1)),'') AS cigar FROM (SELECT a_id, b_id, array_to_string(list_transform(ps, lambda p: CASE WHEN substr(a,p,1)='-' AND substr(b,p,1)='-' THEN '' WHEN substr(a,p,1)='-' THEN 'A' WHEN substr(b,p,1)='-' THEN 'B' ELSE 'M' END),'') AS st FROM {PAIRS} q) q")
_add("SEQ-11", lambda x: B.all_pairs(x.x_aln, ["aln_id"], B.similarity, "similarity double").drop("aln_id"),
     f"SELECT a_id, b_id, len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(translate(a,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1)=substr(translate(b,'{S.CLASSES[0]}','{S.CLASSES[1]}'),p,1)))/nullif(len(list_filter(ps, lambda p: substr(a,p,1)<>'-' AND substr(b,p,1)<>'-')),0) AS similarity FROM {PAIRS} q")
_add("SEQ-34", lambda x: x.x_seq.select("seq_id", F.regexp_replace(F.regexp_replace(F.concat(F.lit("XX"), F.col("pep"), F.lit("*")), "^X+", ""), r"\*$", "").alias("pep")), "SELECT seq_id, ltrim(pep,'X') AS pep FROM x_seq")
_add("GRA-04", lambda x: K.class_by_ancestor(G.ancestors(x.x_tree), "n1", "r"), f"{UP} SELECT node, coalesce(arg_min(contains(ancestor,'n1'), distance) FILTER (WHERE contains(ancestor,'n1') OR contains(ancestor,'r')), false) AS is_inside FROM up GROUP BY node")
_add("SIM-04", lambda x: K.self_maps(x.x_exon), "SELECT exon_id, exon_id AS cognate_exon_id, CAST(1.0 AS DOUBLE) AS similarity, CAST(end_in_gene-start_in_gene+1 AS VARCHAR) || 'M' AS cigar FROM x_exon")
_add("SIM-05", lambda x: K.similar_sequences(x.x_seq.select("seq_id", F.col("pep").alias("seq")), 25, 0.2),
     "WITH k AS (SELECT seq_id, unnest(list_distinct(list_transform(range(1, greatest(length(s)-24,1)+1), lambda p: substr(s,p,25)))) AS gram FROM (SELECT seq_id, pep AS s FROM x_seq) q), n AS (SELECT seq_id, count(*) AS n FROM k GROUP BY seq_id), p AS (SELECT a.seq_id AS a, b.seq_id AS b, count(*) AS c FROM k a JOIN k b ON a.gram=b.gram AND a.seq_id<b.seq_id GROUP BY 1,2) SELECT a, b, c/(x.n+y.n-c) AS jaccard FROM p JOIN n x ON x.seq_id=a JOIN n y ON y.seq_id=b WHERE c/(x.n+y.n-c)>=0.2")


from strandweave.plans import catalog, mapping, tracks  # noqa: E402, F401  they register queries with the fragments above


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, build=build: build(Inputs(spark, sf_dir))) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in _SQL.items()}
