"""Registered queries: dumps and reloads, names and accessions, audits and choices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.adapters import Inputs
from strandweave.functions import sequence as S
from strandweave.operators import aggregates as A
from strandweave.operators import audits as C
from strandweave.operators import filters as P
from strandweave.operators import joins as J
from strandweave.operators import naming as N
from strandweave.plans.registry import COVER, EXON_PEP, MARKED, ORTHO, PEPTIDE, ROUTE, _add, _exon_peptides, _marked, _ortho
from strandweave.session import fresh_path
from strandweave.sources import exchange as X
from strandweave.sources import files as R


def _fasta(x: Inputs) -> str:
    """The peptides written as FASTA, one folder a language."""
    path = fresh_path(x.x_seq.sparkSession, "fasta")
    rows = x.x_seq.where("pep is not null").withColumn("folder", F.coalesce("lang", F.lit("none")))
    named = rows.select("folder", F.concat(F.lit(">"), F.col("seq_id").cast("string"), F.lit("\n"), S.wrapped(F.col("pep"), 50)).alias("value"))
    named.write.partitionBy("folder").text(path)
    return path


def _headers(x: Inputs) -> DataFrame:
    found = X.fasta_headers(x.x_seq.sparkSession, _fasta(x))
    return found.select("name", F.array_join(F.array_distinct(F.transform("files", lambda f: F.regexp_extract(f, "folder=([^/]*)", 1))), ",").alias("folders"))


_add("SRC-01", _headers, "SELECT CAST(seq_id AS VARCHAR) AS name, coalesce(lang,'none') AS folders FROM x_seq WHERE pep IS NOT NULL")
_add("SRC-02", lambda x: R.fasta_records(x.x_seq.sparkSession, _fasta(x)), "SELECT CAST(seq_id AS VARCHAR) AS name, pep AS seq FROM x_seq WHERE pep IS NOT NULL")


def _dumped(x: Inputs) -> DataFrame:
    path = fresh_path(x.orders.sparkSession, "dump")
    day = F.when(F.col("o_orderkey") % 50 == 0, X.NO_DATE).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    R.write_dump(x.orders.select("o_orderkey", day.alias("day"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderpriority")).alias("priority")), path)
    back = R.read_dump(x.orders.sparkSession, path, "o_orderkey long, day string, priority string")
    return back.select("o_orderkey", X.repaired_date(F.col("day")).cast("string").alias("day"), "priority")


_add("SRC-04", _dumped, "SELECT o_orderkey, CASE WHEN o_orderkey%50=0 THEN '1000-01-01' ELSE strftime(o_orderdate,'%Y-%m-%d') END AS day, CASE WHEN o_orderkey%7>0 THEN o_orderpriority END AS priority FROM orders")


def _reloads(x: Inputs) -> DataFrame:
    spark, path = x.x_gene.sparkSession, fresh_path(x.x_gene.sparkSession, "reload")
    early = x.x_gene.where("species_id < 10")
    runs = [X.reload(spark, rows, path, "gene").withColumn("run", F.lit(i)) for i, rows in enumerate([early, early, x.x_gene])]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


_add("SRC-05", _reloads, "WITH n AS (SELECT count(*) AS a, count(CASE WHEN species_id<10 THEN 1 END) AS e FROM x_gene) SELECT 'gene' AS table_name, 0 AS rows_before, e AS rows_source, 'load' AS action, 0 AS run FROM n UNION ALL SELECT 'gene', e, e, 'skip', 1 FROM n UNION ALL SELECT 'gene', e, a, 'load', 2 FROM n")
_add("SRC-06", lambda x: X.tsv_lines(x.x_exon.withColumn("phase", F.when(F.col("is_coding") == 1, F.col("phase"))), ["exon_id", "start_in_gene", "end_in_gene", "phase"], "gene_id", ["exon_id"]),
     r"SELECT concat_ws(chr(9), row_number() OVER (PARTITION BY gene_id ORDER BY exon_id), exon_id, start_in_gene, end_in_gene, CASE WHEN is_coding=1 THEN CAST(phase AS VARCHAR) ELSE '\N' END) AS value FROM x_exon")


def _routed_files(x: Inputs) -> DataFrame:
    path = fresh_path(x.x_gene.sparkSession, "orthologues")
    rows = P.route_homologies(_ortho(x)).select("target", F.concat_ws("\t", F.col("gene_id").cast("string"), F.col("cognate_gene_id").cast("string"), F.col("cognate_species").cast("string")).alias("value"))
    rows.write.partitionBy("target").text(path)
    return x.x_gene.sparkSession.read.text(path).select("target", "value")


_add("SRC-07", _routed_files, f"SELECT * FROM (SELECT {ROUTE} AS target, concat_ws(chr(9), gene_id, cognate_gene_id, cognate_species) AS value FROM {ORTHO} q) q WHERE target IS NOT NULL")


def _searched(x: Inputs) -> DataFrame:
    x.x_gene.createOrReplaceTempView("x_gene")
    return X.non_empty(x.x_gene.sparkSession.sql("SELECT species_id, biotype, count(*) AS n FROM x_gene GROUP BY species_id, biotype"), "gene")


_add("SRC-08", _searched, "SELECT species_id, biotype, count(*) AS n FROM x_gene GROUP BY species_id, biotype")


def _catalog(x: Inputs) -> DataFrame:
    path = fresh_path(x.x_gene.sparkSession, "catalog")
    named = x.x_gene.join(x.nation.select(F.col("n_nationkey").alias("species_id"), N.renamed(N.underscored(F.concat(F.lit("Species "), "n_name")), {"species_nation_3": "species_three"}).alias("species")), "species_id")
    named.select("species", "gene_id", "stable_id").write.partitionBy("species").parquet(path)
    return x.x_gene.sparkSession.read.parquet(path).select("species", "gene_id", "stable_id")


_add("SRC-09", _catalog, "SELECT CASE WHEN n_name='NATION_3' THEN 'species_three' ELSE 'species_' || lower(n_name) END AS species, gene_id, stable_id FROM x_gene JOIN nation ON n_nationkey=species_id")
_add("SRC-14", lambda x: X.exon_dump(x.x_gene, x.x_exon.withColumn("provenance", (F.floor(F.col("exon_id") / 100) % 4).cast("int")), _exon_peptides(x), J.covering_pairs(x.x_exon).select(F.col("covered").alias("exon_id"))),
     f"SELECT e.exon_id, g.stable_id AS gene_stable_id, g.species_id, g.strand, start_in_gene, end_in_gene, is_coding, is_canonical, CASE (e.exon_id//100)%4 WHEN 1 THEN 'E'||e.exon_id WHEN 2 THEN 'sw_sharp_'||e.exon_id WHEN 3 THEN 'usearch_'||e.exon_id ELSE 'anon' END AS stable_id, logic_name AS analysis, p.pep FROM x_exon e JOIN x_gene g ON e.gene_id=g.gene_id AND g.biotype='protein_coding' JOIN {EXON_PEP} p ON p.exon_id=e.exon_id WHERE e.exon_id NOT IN (SELECT covered FROM {COVER} c)")


def _restored(x: Inputs) -> DataFrame:
    fields = F.when(F.col("exon_id") % 5 == 0, F.array_repeat(F.lit("f"), 9)).otherwise(F.array_repeat(F.lit("f"), 16))
    lines = x.x_exon.where("exon_id % 2 = 0").select(F.concat_ws("\t", F.col("gene_id").cast("string"), F.col("exon_id").cast("string"), "logic_name", F.array_join(fields, "\t")).alias("value"))
    base = x.x_exon.where("exon_id % 3 = 0").select(F.concat_ws("_", F.col("gene_id").cast("string"), F.col("exon_id").cast("string")).alias("key"), F.lit("old").alias("payload"))
    return X.store(base, lines, 18, 2)


_add("SRC-15", _restored, "SELECT gene_id || '_' || exon_id AS key, CASE WHEN exon_id%2=0 AND exon_id%5<>0 THEN logic_name ELSE 'old' END AS payload FROM x_exon WHERE exon_id%3=0 OR (exon_id%2=0 AND exon_id%5<>0)")


def _reread_orthologues(x: Inputs) -> DataFrame:
    names = x.nation.select(F.col("n_nationkey").alias("cognate_species"), F.col("n_name").alias("common_name"))
    own, other = (x.x_gene.select(F.col("gene_id").alias(k), F.col("stable_id").alias(v)) for k, v in (("gene_id", "gene"), ("cognate_gene_id", "cognate")))
    full = N.with_common_names(_ortho(x).join(own, "gene_id").join(other, "cognate_gene_id"), names, "cognate_species")
    path = fresh_path(x.x_gene.sparkSession, "orthologues")
    X.pair_lines(full, ["gene", "cognate", "cognate_species", "common_name"]).write.text(path)
    return X.read_orthologues(x.x_gene.sparkSession.read.text(path))


_add("SRC-16", _reread_orthologues, f"SELECT 'G' || lpad(CAST(gene_id AS VARCHAR),11,'0') AS gene, CAST(cognate_species AS VARCHAR) AS species, 'G' || lpad(CAST(max(cognate_gene_id) AS VARCHAR),11,'0') AS cognate, any_value(n_name) AS common_name FROM {ORTHO} q JOIN nation ON n_nationkey=cognate_species GROUP BY gene_id, cognate_species")


def _paralogues(x: Inputs) -> DataFrame:
    a, b = (x.x_gene.select(F.col("gene_id").alias(k), F.col("stable_id").alias(f"{k}_name")) for k in ("first", "second"))
    return J.paralogue_pairs(x.x_hom, x.x_homtype, x.x_gene).join(a, "first").join(b, "second").select(F.col("first_name").alias("first"), F.col("second_name").alias("second")).distinct()


def _reread_paralogues(x: Inputs) -> DataFrame:
    path = fresh_path(x.x_gene.sparkSession, "paralogues")
    X.pair_lines(_paralogues(x), ["first", "second"]).write.text(path)
    return X.read_paralogues(x.x_gene.sparkSession.read.text(path), "G0")


PARA = "(SELECT DISTINCT 'G' || lpad(CAST(first AS VARCHAR),11,'0') AS first, 'G' || lpad(CAST(second AS VARCHAR),11,'0') AS second FROM (SELECT count(*) AS n, min(g.gene_id) AS first, max(g.gene_id) AS second FROM x_hom h JOIN x_homtype t ON h.homology_id=t.homology_id AND t.description='within_species_paralog' JOIN x_gene g ON g.gene_id=h.gene_member_id AND g.biotype='protein_coding' GROUP BY h.homology_id, g.species_id) q WHERE n=2)"
_add("SRC-17", _reread_paralogues, f"SELECT * FROM {PARA} q")


def _unfinished(x: Inputs) -> DataFrame:
    spark, path = x.x_gene.sparkSession, fresh_path(x.x_gene.sparkSession, "done")
    x.x_gene.where("species_id < 10").select("species_id", "gene_id").write.partitionBy("species_id").parquet(path)
    return X.unfinished(x.x_gene, spark.read.parquet(path), "species_id")


_add("SRC-18", _unfinished, "SELECT DISTINCT species_id FROM x_gene WHERE species_id>=10")
_versioned = lambda x: x.x_seq.select(F.concat_ws(".", F.col("seq_id").cast("string"), (F.col("seq_id") % 3 + 1).cast("string")).alias("name"), "pep")
_add("SRC-23", lambda x: X.subset_records(_versioned(x), x.labels.where("quality = 1").select(F.col("doc_id").cast("string").alias("id"))), "SELECT seq_id || '.' || (seq_id%3+1) AS name, pep FROM x_seq WHERE seq_id IN (SELECT doc_id FROM labels WHERE quality=1)")
_add("AGG-16", lambda x: X.versions_per_id(x.lineitem.select(F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("name"), "l_linenumber"), "l_linenumber").select("id", F.array_join("versions", ",").alias("versions")),
     "SELECT CAST(l_orderkey AS VARCHAR) AS id, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS versions FROM lineitem GROUP BY l_orderkey")

# names
_common = lambda x: x.part.select("p_partkey", F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("species"), F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("Common "), "p_type")).alias("common"), F.concat(F.lit("ENSEiJ_"), "p_brand").alias("code"))
_add("FLT-13", lambda x: _common(x).select("p_partkey", N.trivial_name(F.col("species"), F.col("common"), {"part_5": "five"}).alias("trivial_name"), N.shorthand(F.col("code"), {"BRAND#1": "ONE"}).alias("shorthand")),
     "SELECT p_partkey, CASE WHEN p_partkey=5 THEN 'five' WHEN p_partkey%3=0 THEN 'part_' || p_partkey ELSE replace(lower(p_type),' ','_') END AS trivial_name, CASE WHEN upper(p_brand)='BRAND#1' THEN 'ONE' ELSE upper(p_brand) END AS shorthand FROM part")
_add("JOIN-25", lambda x: N.with_common_names(_ortho(x), x.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("cognate_species"), F.col("n_name").alias("common_name")), "cognate_species").select("gene_id", "cognate_gene_id", "description", "common_name"),
     f"SELECT gene_id, cognate_gene_id, description, n_name AS common_name FROM {ORTHO} q LEFT JOIN nation ON n_nationkey=cognate_species AND n_nationkey%2=0")
_add("JOIN-26", lambda x: N.genome_names(x.nation.select(F.col("n_name").alias("species")), x.nation.where("n_nationkey < 20").select(F.col("n_name").alias("genome_name"), F.col("n_nationkey").alias("genome_id")), {"NATION_3": "NATION_30", "NATION_21": "NATION_4"}),
     "SELECT a.n_name AS species, b.n_nationkey AS genome_id, b.n_nationkey IS NOT NULL AS matched FROM nation a LEFT JOIN nation b ON b.n_nationkey<20 AND b.n_name=CASE a.n_name WHEN 'NATION_3' THEN 'NATION_30' WHEN 'NATION_21' THEN 'NATION_4' ELSE a.n_name END")
_add("GRA-08", lambda x: N.with_common_names(x.x_gene.select("gene_id", "species_id"), x.nation.join(x.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("species_id"), F.col("n_name").alias("taxon"), F.col("r_name").alias("clade")), "species_id"),
     "SELECT gene_id, species_id, n_name AS taxon, r_name AS clade FROM x_gene LEFT JOIN nation ON n_nationkey=species_id LEFT JOIN region ON r_regionkey=n_regionkey")
_add("JOIN-20", lambda x: N.protein_symbols(x.x_tl.select("transcript_id", F.concat(F.lit("P"), F.col("transcript_id").cast("string")).alias("protein_id")), x.x_tr, x.supplier.select(F.col("s_suppkey").alias("gene_id"), F.col("s_name").alias("symbol"))),
     "SELECT 'P' || l.transcript_id AS protein_id, coalesce(s_name, 'P' || l.transcript_id) AS symbol FROM x_tl l JOIN (SELECT DISTINCT transcript_id, gene_id FROM x_tr) r ON l.transcript_id=r.transcript_id LEFT JOIN supplier ON s_suppkey=r.gene_id")
_add("JOIN-21", lambda x: N.primary_accessions(x.orders.select(F.col("o_orderkey").alias("list_id"), F.when(F.col("o_orderkey") % 9 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat_ws(";", F.col("o_custkey").cast("string"), (F.col("o_orderkey") % 1000 + 5000000).cast("string"))).alias("ids")), x.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("id"))),
     "SELECT primary_id AS \"primary\", coalesce(string_agg(DISTINCT s, ';' ORDER BY s),'') AS secondaries FROM (SELECT CAST(o_custkey AS VARCHAR) AS primary_id, CASE WHEN o_orderkey%9<>0 THEN CAST(o_orderkey%1000+5000000 AS VARCHAR) END AS s FROM orders WHERE o_custkey%2=0 AND o_custkey IN (SELECT c_custkey FROM customer) OR o_orderkey%9=0) q GROUP BY primary_id")
_add("JOIN-22", lambda x: N.synonyms(x.customer.select(F.concat_ws("\t", F.lower("c_name"), F.concat(F.lit('"'), F.lower("c_mktsegment"), F.lit('"')), F.concat(F.lit("G"), F.lpad(F.col("c_custkey").cast("string"), 11, "0"))).alias("value")), x.x_gene, "G0"),
     "SELECT DISTINCT synonym, stable_id FROM (SELECT upper(c_name) AS synonym, c_custkey AS k FROM customer UNION ALL SELECT upper(c_mktsegment), c_custkey FROM customer) q JOIN x_gene ON gene_id=k")


def _candidates(x: Inputs) -> DataFrame:
    told = x.x_gene.select(F.col("gene_id").alias("cognate_gene_id"), F.concat_ws(" ", "biotype", F.col("region_id").cast("string")).alias("told"))
    kind = F.when(F.col("description") == "ortholog_one2one", 0).when(F.contains("description", F.lit("ortho")), 1).otherwise(2)
    return _ortho(x).join(told, "cognate_gene_id").select("gene_id", F.col("cognate_species").alias("species_rank"), kind.alias("type_rank"), F.col("told").alias("description"))


_add("JOIN-23", lambda x: N.transferred_annotation(_candidates(x), ["LncRNA"]),
     f"WITH c AS (SELECT o.gene_id, cognate_species AS sr, CASE WHEN description='ortholog_one2one' THEN 0 WHEN contains(description,'ortho') THEN 1 ELSE 2 END AS tr, g.biotype || ' ' || g.region_id AS d FROM {ORTHO} o JOIN x_gene g ON g.gene_id=o.cognate_gene_id), f AS (SELECT *, min(tr) OVER (PARTITION BY gene_id, sr) AS m FROM c), t AS (SELECT gene_id, sr, string_agg(d,'; ' ORDER BY d) AS annotation FROM f WHERE tr=m AND NOT contains(lower(d),'lncrna') GROUP BY gene_id, sr) SELECT gene_id, sr AS species_rank, annotation FROM (SELECT *, min(sr) OVER (PARTITION BY gene_id) AS b FROM t) q WHERE sr=b")
_add("SEQ-32", lambda x: x.x_gene.select("gene_id", N.annotated_header(F.col("stable_id"), F.when(F.col("region_id") > 0, F.col("biotype")), F.concat(F.lit("species_"), F.col("species_id").cast("string")), F.col("species_id") == 3).alias("header")),
     "SELECT gene_id, '>' || stable_id || ' ' || CASE WHEN region_id>0 THEN biotype ELSE 'none' END || CASE WHEN species_id<>3 AND region_id>0 THEN ' [by sim to species_' || species_id || ']' ELSE '' END AS header FROM x_gene")
_add("TOP-06", lambda x: N.by_rank(x.x_gene.select("species_id", F.col("region_id").alias("group_id"), F.col("stable_id").alias("name")), x.nation.where("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("species_id"), (-F.col("n_nationkey")).alias("rank"))),
     "SELECT region_id AS group_id, row_number() OVER (PARTITION BY region_id ORDER BY -species_id, stable_id) AS position, stable_id AS name FROM x_gene WHERE species_id%4>0")
_add("TOP-07", lambda x: N.output_order(A.joined_list(x.x_hom, "homology_id", "gene_member_id", ",", "hits").select(F.col("homology_id").cast("string").alias("bait"), "hits")),
     "SELECT bait, CAST(p AS INT) AS position, name FROM (SELECT CAST(homology_id AS VARCHAR) AS bait, row_number() OVER (PARTITION BY homology_id ORDER BY gene_member_id) AS p, CAST(gene_member_id AS VARCHAR) AS name FROM x_hom) q WHERE name<>bait UNION ALL SELECT DISTINCT CAST(homology_id AS VARCHAR), 0, CAST(homology_id AS VARCHAR) FROM x_hom")
_add("SET-05", lambda x: N.level_difference(x.x_gene.groupBy(F.col("region_id").alias("group_id"), (F.col("gene_id") % 3).alias("level_no")).agg(F.array_sort(F.collect_set("species_id")).alias("members"))).select("group_id", "level_no", F.array_join(F.transform("own", lambda m: m.cast("string")), ",").alias("own")),
     "WITH m AS (SELECT DISTINCT region_id AS g, gene_id%3 AS l, species_id AS s FROM x_gene), v AS (SELECT DISTINCT g, l FROM m), p AS (SELECT g, l, lag(l) OVER (PARTITION BY g ORDER BY l) AS b FROM v) SELECT p.g AS group_id, p.l AS level_no, coalesce(string_agg(CAST(m.s AS VARCHAR), ',' ORDER BY m.s) FILTER (WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.g=p.g AND o.l=p.b AND o.s=m.s)),'') AS own FROM p JOIN m ON m.g=p.g AND m.l=p.l GROUP BY p.g, p.l")
_add("SET-06", lambda x: N.new_ids(x.lineitem.select(F.concat_ws("-", F.concat(F.lit("P"), F.col("l_partkey").cast("string")), F.col("l_linenumber").cast("string")).alias("id")), x.part.where("p_size > 25").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"))),
     "SELECT DISTINCT 'P' || l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size>25)")

# audits and choices
_add("FLT-07", lambda x: C.ccds_support(x.x_tr.select("transcript_id", "gene_id").distinct(), x.x_hom.select(F.col("gene_member_id").alias("gene_id"), F.col("homology_id").alias("feature_id")).join(x.x_tr.select("transcript_id", "gene_id").distinct(), "gene_id").select("transcript_id", "feature_id"), x.part.select(F.col("p_partkey").alias("feature_id"), F.when(F.col("p_size") % 2 == 0, "dna_align_feature").otherwise("protein_align_feature").alias("feature_type"), F.concat_ws(".", F.when(F.col("p_size") < 30, "CCDS").otherwise("NM"), F.col("p_partkey").cast("string")).alias("hit_name"))),
     "SELECT transcript_id, 'CCDS.' || max(p_partkey) AS hit_name FROM (SELECT DISTINCT transcript_id, gene_id FROM x_tr) t JOIN x_hom h ON h.gene_member_id=t.gene_id JOIN part ON p_partkey=h.homology_id AND p_size%2=0 AND p_size<30 GROUP BY transcript_id")


def _templates(x: Inputs) -> DataFrame:
    return x.x_pair.select("exon_id", "cognate_exon_id", "part", F.col("species_id").alias("distance"), (F.col("cognate_exon_id") % 97).alias("n"), F.when(F.col("part") % 5 > 0, "acg").otherwise("").alias("left"), F.when(F.col("part") % 3 == 0, "MXXK").otherwise("MK").alias("pep"), F.when(F.col("part") % 7 == 0, "patched").alias("warning"))


_ok = lambda: C.acceptable_template(F.col("n"), F.lit(40), F.col("left"), F.lit("gt"), F.col("pep"), F.col("warning"))
OK = "(cognate_exon_id%97)/40.0 BETWEEN 0.3 AND 1/0.3 AND part%5>0 AND part%3<>0 AND part%7<>0"
_add("FLT-16", lambda x: _templates(x).where(_ok()).select("exon_id", "cognate_exon_id", "part"), f"SELECT exon_id, cognate_exon_id, part FROM x_pair WHERE {OK}")
_add("TOP-04", lambda x: C.first_template(_templates(x), _ok()).select("exon_id", "cognate_exon_id", "part"), f"SELECT exon_id, cognate_exon_id, part FROM (SELECT *, row_number() OVER (PARTITION BY exon_id ORDER BY species_id, cognate_exon_id, part) AS rn FROM x_pair WHERE {OK}) q WHERE rn=1")
_add("TOP-03", lambda x: C.best_hits(x.lineitem.select(F.col("l_partkey").alias("query_id"), F.col("l_orderkey").alias("target_id"), F.col("l_quantity").cast("int").alias("match_length"), F.lit(60).alias("query_length"), (F.col("l_suppkey") % 90 + 10).alias("target_length"), (F.col("l_linenumber") * 5).alias("identity"), F.col("l_linenumber").alias("first"), (F.col("l_suppkey") * 100).alias("offset"))),
     "SELECT query_id, target_id, match_length, o+f AS first FROM (SELECT l_partkey AS query_id, l_orderkey AS target_id, CAST(l_quantity AS INT) AS match_length, l_suppkey*100 AS o, l_linenumber AS f, row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_quantity AS INT) DESC, l_orderkey, l_linenumber, l_suppkey DESC) AS rn FROM lineitem WHERE CAST(l_quantity AS INT)>=0.4*least(60, l_suppkey%90+10) AND l_linenumber*5>=10) q WHERE rn=1")
_add("JOIN-12", lambda x: C.patch_regions(x.x_gene, x.nation.select((F.col("n_nationkey") % 7).cast("long").alias("region_id"), F.when(F.col("n_regionkey") < 2, "PATCH_FIX").when(F.col("n_regionkey") == 2, "HAP").otherwise("PATCH_NOVEL").alias("exc_type"), F.col("n_nationkey").alias("exc_region_id"), (F.col("n_nationkey") * 1000).alias("exc_start"), (F.col("n_nationkey") * 1000 + 500).alias("exc_end")), x.nation.select(F.col("n_nationkey").alias("exc_region_id"), F.col("n_name").alias("region_name"))),
     "SELECT gene_id, CASE WHEN n_regionkey<2 THEN 'PATCH_FIX' ELSE 'PATCH_NOVEL' END AS exc_type, n_name AS region_name, n_nationkey*1000 AS exc_start, n_nationkey*1000+500 AS exc_end FROM x_gene JOIN nation ON region_id=n_nationkey%7 AND n_regionkey<>2")
_add("JOIN-18", lambda x: C.genes_of_exons(x.x_tr.select("exon_id", (F.col("exon_id") % 4).alias("provenance")).distinct(), x.x_exon.withColumn("provenance", F.floor(F.col("exon_id") / 100) % 4)), "SELECT exon_id, exon_id%4 AS provenance, gene_id FROM x_exon WHERE exon_id%4=(exon_id//100)%4")


def _regions(x: Inputs) -> DataFrame:
    own = x.x_seq.where("length(pep) >= 20").select(F.col("seq_id").alias("gene_id"), F.col("pep").alias("stored"))
    one = lambda source, priority, built: own.select("gene_id", F.lit(source).alias("source"), F.lit(priority).alias("priority"), built.alias("built"), "stored")
    primary = F.when(F.col("gene_id") % 3 == 0, F.reverse("stored")).otherwise(F.concat(F.lit("XX"), "stored"))
    return one("primary", 0, primary).unionByName(one("patch", 1, F.when(F.col("gene_id") % 2 == 0, F.expr("substr(stored, 1, length(stored) - 2)")).otherwise(F.lit(""))))


_add("JOIN-29", lambda x: C.region_choice(_regions(x)),
     "WITH o AS (SELECT seq_id AS g, ltrim(pep,'X') AS s, ltrim(reverse(pep),'X') AS r FROM x_seq WHERE length(pep)>=20), k AS (SELECT g, CASE WHEN g%3=0 THEN abs(length(s)-length(r))<=3 AND len(list_filter(range(1,least(length(s),length(r))+1), lambda p: substr(s,p,1)<>substr(r,p,1)))<=2 ELSE true END AS p FROM o) SELECT g AS gene_id, CASE WHEN p THEN 'primary' ELSE 'patch' END AS source FROM k WHERE p OR g%2=0")
_add("AGG-09", lambda x: C.map_holes(x.x_exon.where("is_canonical = 1 and is_coding = 1").select("gene_id", "exon_id"), x.x_pair.withColumn("novel", (F.col("part") % 4 == 0).cast("int"))),
     "WITH e AS (SELECT gene_id, exon_id FROM x_exon WHERE is_canonical=1 AND is_coding=1), i AS (SELECT * FROM e WHERE gene_id IN (SELECT gene_id FROM e JOIN x_pair p ON p.exon_id=e.exon_id)), g AS (SELECT s.species_id, i.exon_id, max(p.similarity) AS m, max(CASE WHEN p.part%4=0 THEN 1 ELSE 0 END) AS nv FROM (SELECT DISTINCT species_id FROM x_pair WHERE exon_id IN (SELECT exon_id FROM i)) s CROSS JOIN i LEFT JOIN x_pair p ON p.exon_id=i.exon_id AND p.species_id=s.species_id GROUP BY 1,2) SELECT species_id, count(*) AS n_exons, count(CASE WHEN m IS NULL OR m<0.2 THEN 1 END) AS n_holes, CAST(sum(CASE WHEN m IS NOT NULL THEN nv ELSE 0 END) AS BIGINT) AS n_novel FROM g GROUP BY species_id")


def _stored(x: Inputs) -> DataFrame:
    seq = x.x_seq.select((F.col("seq_id") * 100 + 1).alias("exon_id"), "seq_id", "dna")
    pep = F.when(F.col("seq_id") % 7 == 0, "-10").when(F.col("seq_id") % 2 == 0, S.translate(F.col("dna"))).otherwise("M")
    return x.x_exon.where("is_coding = 1").select("exon_id").join(seq.withColumn("pep", pep), "exon_id", "left")


_add("AGG-14", lambda x: C.translation_audit(_stored(x)),
     f"SELECT status, count(*) AS n FROM (SELECT CASE WHEN dna IS NULL THEN 'no_sequence' WHEN length(dna)<3 THEN 'too_short' WHEN seq_id%7=0 THEN 'failed' WHEN seq_id%2=0 OR p='M' THEN 'ok' ELSE 'mismatch' END AS status FROM x_exon LEFT JOIN (SELECT seq_id, dna, {PEPTIDE} AS p FROM x_seq) s ON exon_id=seq_id*100+1 WHERE is_coding=1) q GROUP BY status")
_add("AGG-15", lambda x: C.length_agreement(A.reading_frames(P.effective_bounds(_marked(x))), x.x_seq.select(F.col("seq_id").alias("gene_id"), "pep")),
     f"SELECT gene_id, n AS coding_length, length(p) AS pep_length, abs(floor(n/3)-length(p))<=3 AS agrees FROM (SELECT gene_id, CAST(sum(CASE WHEN is_coding=1 THEN CASE WHEN canon_transl_end<0 THEN end_in_gene ELSE canon_transl_end END - CASE WHEN canon_transl_start<0 THEN start_in_gene ELSE canon_transl_start END + 1 ELSE 0 END) AS BIGINT) AS n FROM {MARKED} q WHERE in_canonical=1 GROUP BY gene_id) q JOIN (SELECT seq_id, pep AS p FROM x_seq) s ON seq_id=gene_id")
_add("WIN-11", lambda x: C.reading_length(_marked(x).select("gene_id", "exon_id", "start_in_gene", "end_in_gene", (F.col("canon_transl_start") >= 0).cast("int").alias("is_first"), (F.col("canon_transl_end") >= 0).cast("int").alias("is_last"))),
     f"SELECT gene_id, CAST(sum(CASE WHEN b=1 AND coalesce(e,0)=0 THEN end_in_gene-start_in_gene+1 ELSE 0 END) AS BIGINT) AS reading_length FROM (SELECT *, max(CASE WHEN canon_transl_start>=0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, max(CASE WHEN canon_transl_end>=0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM {MARKED} q WINDOW w AS (PARTITION BY gene_id ORDER BY start_in_gene, exon_id)) q GROUP BY gene_id")
_add("AGG-20", lambda x: C.splice_audit(x.x_tr.where("transcript_id % 3 = 0").select("gene_id", "exon_id"), x.x_seq.select((F.col("seq_id") * 100 + 1).alias("exon_id"), F.when(F.col("seq_id") % 4 > 0, F.col("pep")).alias("pep"), F.when(F.col("seq_id") % 5 > 0, F.col("dna")).alias("dna")), J.covering_pairs(x.x_exon).select(F.col("covered").alias("exon_id"), "master")),
     f"WITH t AS (SELECT DISTINCT gene_id, exon_id FROM x_tr WHERE transcript_id%3=0), c AS (SELECT covered, min(master) AS m FROM {COVER} q GROUP BY covered) SELECT status, count(*) AS n FROM (SELECT CASE WHEN s.seq_id IS NULL THEN 'no_sequence' WHEN s.seq_id%4=0 OR coalesce(length(pep),0)=0 THEN 'no_protein' WHEN s.seq_id%5=0 OR coalesce(length(dna),0)=0 THEN 'no_dna' WHEN m IS NULL THEN 'uncovered' WHEN m IN (SELECT exon_id FROM t) THEN 'cover_present' ELSE 'cover_not_supported' END AS status FROM t LEFT JOIN x_seq s ON t.exon_id=s.seq_id*100+1 LEFT JOIN c ON c.covered=t.exon_id) q GROUP BY status")
_add("AGG-21", lambda x: C.missing_exon_counts(x.x_pair.select("species_id", (F.col("similarity") >= 0.5).cast("int").alias("found"), F.when(F.col("part") % 6 == 0, "ACNNNG").otherwise("ACG").alias("region"))),
     "SELECT species_id, count(*) AS sought, count(CASE WHEN similarity>=0.5 THEN 1 END) AS found, count(CASE WHEN part%6=0 THEN 1 END) AS unsequenced FROM x_pair GROUP BY species_id")
AA = lambda codon: f"substr('{S.STANDARD}', CAST(1+16*(strpos('TCAG', substr({codon},1,1))-1)+4*(strpos('TCAG', substr({codon},2,1))-1)+(strpos('TCAG', substr({codon},3,1))-1) AS INT), 1)"
_add("AGG-24", lambda x: C.mutation_background(x.x_seq.select(F.col("seq_id").alias("gene_id"), "dna")),
     f"WITH p AS (SELECT seq_id, dna, unnest(range(0, CAST(3*floor(length(dna)/3) AS BIGINT))) AS i FROM x_seq), q AS (SELECT seq_id, substr(dna, 3*(i//3)+1, 3) AS codon, i%3 AS k, substr(dna,i+1,1) AS base, (substr(dna,i+1,1)='C' AND substr(dna,i+2,1)='G') OR (substr(dna,i+1,1)='G' AND i>0 AND substr(dna,i,1)='C') AS cpg FROM p), s AS (SELECT *, substr(codon,1,k) || b || substr(codon,k+2) AS nc FROM q, (SELECT unnest(['A','C','G','T']) AS b) w WHERE b<>base) SELECT seq_id AS gene_id, CASE WHEN cpg THEN 'CpG' WHEN base IN ('A','T') THEN 'AT' ELSE 'CG' END || CASE WHEN translate(base,'AGCT','GATC')=b THEN '_transition' ELSE '_transversion' END AS category, CASE WHEN {AA('codon')}={AA('nc')} THEN 'silent' WHEN {AA('nc')}='*' THEN 'nonsense' ELSE 'missense' END AS effect, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1,2,3")
_add("WIN-10", lambda x: C.unseen_paralogues(_paralogues(x)), f"SELECT first, second FROM {PARA} a WHERE NOT EXISTS (SELECT 1 FROM {PARA} b WHERE b.second=a.first AND b.first<a.first)")
_add("WIN-08", lambda x: C.renumbered(x.x_pair.groupBy("exon_id", "cognate_exon_id").agg(F.max("similarity").cast("double").alias("similarity")).select(F.concat(F.lit("e"), F.col("exon_id").cast("string")).alias("base"), F.col("cognate_exon_id").alias("name"), "similarity")).select("base", "name", "new_name"),
     "SELECT base, name, CASE WHEN n=1 THEN base ELSE base || '_' || n END AS new_name FROM (SELECT 'e' || exon_id AS base, cognate_exon_id AS name, row_number() OVER (PARTITION BY exon_id ORDER BY max(similarity) DESC, cognate_exon_id) AS n FROM x_pair GROUP BY exon_id, cognate_exon_id) q")
_add("SIM-08", lambda x: C.input_set(x.customer.select(F.col("c_name").alias("symbol")), x.customer.select(F.col("c_name").alias("symbol"), F.col("c_custkey").alias("gene_id")), _ortho(x).where("description = 'ortholog_one2one'").select("gene_id", F.col("cognate_gene_id").alias("member_id"), F.col("cognate_species").alias("species_id")).distinct(), x.nation.select(F.col("n_nationkey").alias("species_id"), (-F.col("n_nationkey")).alias("rank"))),
     f"SELECT c_custkey AS gene_id, c_custkey AS member_id, 0 AS position FROM customer UNION ALL SELECT gene_id, cognate_gene_id, CAST(row_number() OVER (PARTITION BY gene_id ORDER BY -cognate_species, cognate_gene_id) AS INT) FROM (SELECT DISTINCT gene_id, cognate_gene_id, cognate_species FROM {ORTHO} q WHERE description='ortholog_one2one') q JOIN customer ON c_custkey=gene_id")
_add("TOP-05", lambda x: C.random_rows(x.x_gene.select("gene_id", "species_id"), 30, 7, "gene_id"), None)
_add("TOP-05-choices", lambda x: C.random_choices(x.x_gene.select("gene_id"), 50, 7, "gene_id"), None)
_add("SIM-07", lambda x: _novel(x), "SELECT gene_id*10+exon_id%7 AS slot, CASE WHEN mod(max(exon_id),2)=0 THEN max(exon_id) ELSE min(exon_id) END AS exon_id FROM x_exon GROUP BY 1")


def _novel(x: Inputs) -> DataFrame:
    """Upsert by slot: the greatest exon of a slot where it is even, else the first stored one."""
    slot = (F.col("gene_id") * 10 + F.col("exon_id") % 7).alias("slot")
    stored = x.x_exon.groupBy(slot).agg(F.min("exon_id").alias("exon_id"))
    new = x.x_exon.groupBy(slot).agg(F.max("exon_id").alias("exon_id")).where("exon_id % 2 = 0")
    return R.upsert(stored, new, ["slot"], ["exon_id"])
