"""Views that give the driver's tables the shapes of annotation tables (texts of FIXTURES.md)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Run in Spark and DuckDB alike but for the markers {S}, the string type, and {G}, the flag for all matches.
VIEWS = {
    "x_gene": "SELECT o.o_orderkey AS gene_id, concat('G', lpad(CAST(o.o_orderkey AS {S}), 11, '0')) AS stable_id, c.c_nationkey AS species_id, CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'protein_coding' WHEN o.o_orderpriority='3-MEDIUM' THEN 'pseudogene' ELSE 'lncRNA' END AS biotype, CASE WHEN o.o_orderstatus='F' THEN -1 ELSE 1 END AS strand, o.o_custkey % 7 AS region_id, o.o_orderkey*10000+1 AS region_start, o.o_orderkey*10000+6000 AS region_end FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey",
    "x_exon": "SELECT gene_id, gene_id*100+n AS exon_id, s AS start_in_gene, s+3*q-1 AS end_in_gene, is_coding, is_canonical, logic_name, phase FROM (SELECT l_orderkey AS gene_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity,l_discount,l_tax,l_shipdate) AS n, (l_partkey*37+l_suppkey*11)%4000 AS s, CAST(l_quantity AS INT) AS q, CASE WHEN l_returnflag<>'N' THEN 1 ELSE 0 END AS is_coding, CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END AS is_canonical, CASE l_returnflag WHEN 'A' THEN 'ensembl' WHEN 'R' THEN 'havana' ELSE 'other' END AS logic_name, l_linenumber%3 AS phase FROM lineitem) t",
    "x_seq": "SELECT doc_id AS seq_id, lang, source, translate(a,'abcdefghijklmnopqrstuvwxyz','ACGTACGTACGTACGTACGTACGTAC') AS dna, translate(a,'abcdefghijklmnopqrstuvwxyz','ARNDCQEGHILKMFPSTWYVARNDCQ') AS pep FROM (SELECT doc_id, lang, source, regexp_replace(lower(text),'[^a-z]',''{G}) AS a FROM documents) t",
    "x_aln": "SELECT concat(lang,'_',source) AS aln_id, doc_id AS seq_id, rpad(substr(translate(regexp_replace(lower(text),'[^a-z]',''{G}),'abcdefghijklmnopqrstuvwxyz','ARND-QEGHILKM-PSTWYVARNDCX'),1,60),60,'-') AS seq FROM documents",
    "x_tree": "SELECT concat('c',CAST(c_custkey AS {S})) AS node, concat('n',CAST(c_nationkey AS {S})) AS parent FROM customer UNION ALL SELECT concat('n',CAST(n_nationkey AS {S})), concat('r',CAST(n_regionkey AS {S})) FROM nation UNION ALL SELECT concat('r',CAST(r_regionkey AS {S})), 'root' FROM region",
    "x_tr": "SELECT gene_id, exon_id, gene_id*10+exon_id%3 AS transcript_id, CASE WHEN exon_id%3=(gene_id*100+1)%3 THEN 1 ELSE 0 END AS is_canonical_transcript FROM x_exon",
    "x_tl": "SELECT transcript_id, min(exon_id) AS start_exon_id, CAST(2 AS INT) AS seq_start, max(exon_id) AS end_exon_id, CAST(3 AS INT) AS seq_end FROM x_tr GROUP BY transcript_id",
    "x_hom": "SELECT DISTINCT l_partkey AS homology_id, l_orderkey AS gene_member_id FROM lineitem",
    "x_homtype": "SELECT p_partkey AS homology_id, CASE p_size%6 WHEN 0 THEN 'ortholog_one2one' WHEN 1 THEN 'apparent_ortholog_one2one' WHEN 2 THEN 'possible_ortholog' WHEN 3 THEN 'ortholog_one2many' WHEN 4 THEN 'ortholog_many2many' ELSE 'within_species_paralog' END AS description FROM part",
    "x_pair": "SELECT a.exon_id, b.exon_id AS cognate_exon_id, b.species_id, a.part, (a.exon_id*7+b.exon_id*13)%1000/1000.0 AS similarity FROM (SELECT l_orderkey*10+l_linenumber AS exon_id, l_partkey AS part, CAST(l_suppkey%25 AS INT) AS species_id FROM lineitem WHERE l_quantity>=45) a JOIN (SELECT l_orderkey*10+l_linenumber AS exon_id, l_partkey AS part, CAST(l_suppkey%25 AS INT) AS species_id FROM lineitem WHERE l_quantity>=45) b ON a.part=b.part AND a.exon_id<b.exon_id",
}


class Inputs:
    """Tables of a folder and views over them, by name and made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            for used in re.findall(r"\b(?:FROM|JOIN) (\w+)", VIEWS[name]):
                getattr(self, used).createOrReplaceTempView(used)
            df = self._spark.sql(VIEWS[name].replace("{S}", "STRING").replace("{G}", ""))
        elif name in TABLES:
            df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df


def with_views(sql: str) -> str:
    """DuckDB SQL in front of which the views it names are declared."""
    wanted: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bx_\w+", text)):
            if name in VIEWS and name not in wanted:
                need(VIEWS[name])
                wanted.append(name)

    need(sql)
    heads = [f"{n} AS ({VIEWS[n].replace('{S}', 'VARCHAR').replace('{G}', chr(44) + repr('g'))})" for n in wanted]
    sql = sql.strip()
    recursive = sql.upper().startswith("WITH RECURSIVE")
    if sql.upper().startswith("WITH"):
        sql = sql[len("WITH RECURSIVE") if recursive else len("WITH") :].strip()
        return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join([*heads, sql])
    return f"WITH {', '.join(heads)} {sql}" if heads else sql
