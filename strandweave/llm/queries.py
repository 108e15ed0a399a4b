"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import chat, filter_audit, language, minhash_forest, mixing, piece_bpe, quality, secret_scan, spelling, surrogates, url_filter, vector_graph, wavelet

#: Secret of the surrogates in the registered queries; a real job sets its own.
SURROGATE_KEY = "strandweave"
#: Rules of the url query: verdict, host, path prefix.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_surrogates(spark, sf_dir):
    return surrogates.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op2_vector_graph(spark, sf_dir):
    return vector_graph.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_adaptive_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_word_backoff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()).select("doc_id", "text", "lang"))
    return language.predict(docs.select("doc_id", "text", language.held_out().alias("held_out")), model).drop("text")


def op5_wavelet_shards(spark, sf_dir):
    return wavelet.documents_to_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_soft_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_minhash_forest(spark, sf_dir):
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op8_digest_array(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    files = url_filter.write_digests(url_filter.listed_entries(pages), "entry")
    return url_filter.judge(pages, URL_RULES, files)


def op9_chat_grammar(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.format_and_read(turns.unionByName(own))


def op10_piece_model(spark, sf_dir):
    return piece_bpe.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_bloom_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_exact_shapley(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counts = filter_audit.tabulate(docs, table(spark, sf_dir, "labels"), filter_audit.text_rules(F.col("text")), "E")
    return filter_audit.audit(counts, "ABCDE")


def op13_guess_cost(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    base = F.sha2(secret_scan.joined(of("assign", "access", "hex")), 256)
    return found.select("doc_id", *counts[:3], base.alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"), counts[3], "most_bits")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = [op1_surrogates, op2_vector_graph, op3_adaptive_quality, op4_word_backoff, op5_wavelet_shards, op6_soft_mixing, op7_minhash_forest, op8_digest_array, op9_chat_grammar, op10_piece_model, op11_bloom_spelling, op12_exact_shapley, op13_guess_cost, pipeline]
    return {f.__name__: f for f in own}


OP7 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS h, len(sh) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.m AS component_id, s.doc_id = c.m AS kept FROM s JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) c ON s.doc_id = c.x
"""
OP8 = r"""
WITH h AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path, url FROM pages),
b AS (SELECT host AS entry FROM h WHERE host <> '' GROUP BY host HAVING regexp_matches(host, '(^|[.-])(spam|ads|ad|porn|casino|malware|phish|track|tracker)([.-]|$)') OR (count(*) >= 2 AND 100 * count(*) FILTER (WHERE regexp_matches(url, '[?&]utm_')) >= 30 * count(*))),
j AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN EXISTS (SELECT 1 FROM b WHERE j.host = entry OR ends_with(j.host, '.' || entry)) THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
OP9 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, CASE WHEN contains(role, ': ') THEN '[^\\<#:]' WHEN contains(role, '### ') OR contains(text, '### ') THEN '[^\\<#]'
  WHEN contains(role, '</turn>') OR contains(text, '</turn>') THEN '[^\\<]' WHEN contains(role, '\') OR contains(text, '\') THEN '[^\\]' END AS others FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text) + coalesce(length(regexp_replace(role || text, others, '', 'g')), 0)) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
OP2 = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT v.vec_id, coalesce(n.k, 0) AS n_links, c.m AS component_id, v.vec_id = c.m AS kept FROM embeddings v JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) c ON v.vec_id = c.x LEFT JOIN (SELECT x, count(*) AS k FROM p GROUP BY x) n ON n.x = v.vec_id
"""
#: The breaks by exact quantiles: they are the sketches' as long as no group has more rows than a sketch keeps.
_STEPS = [0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 1.0]
_LADDER = lambda c, low: "[" + ", ".join(f"quantile_disc({c}, {1 - q if low else q})" for q in _STEPS) + "]"
_SIDES = [("symbol_rate", 0), ("dup_line_rate", 0), ("repeat_rate", 0), ("word_length", 0), ("word_length", 1)]
_BREAKS = lambda keys: f"SELECT {keys}count(*) AS n, " + ", ".join(f"{_LADDER(c, low)} AS {c}_{low}" for c, low in _SIDES) + " FROM r WHERE NOT base_failed"
_MIDDLE = "CASE WHEN list_max(list_transform(range(1, 7), lambda i: abs({0}[i + 1] - {0}[i]))) = 0 THEN {0}[7] ELSE ({0}[1 + list_position(list_transform(range(1, 7), lambda i: abs({0}[i + 1] - {0}[i])), list_max(list_transform(range(1, 7), lambda i: abs({0}[i + 1] - {0}[i]))))] + {0}[list_position(list_transform(range(1, 7), lambda i: abs({0}[i + 1] - {0}[i])), list_max(list_transform(range(1, 7), lambda i: abs({0}[i + 1] - {0}[i]))))]) / 2 END"
_BOUND = lambda c, low: f"(o.n * ({_MIDDLE.format(f'o.{c}_{low}')}) + 100 * ((l.n * ({_MIDDLE.format(f'l.{c}_{low}')}) + 100 * ({_MIDDLE.format(f'a.{c}_{low}')})) / (l.n + 100))) / (o.n + 100)"
OP3 = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
h AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6), lambda j: array_to_string(ws[j:j + 7], ' '))) AS x FROM w WHERE len(ws) >= 8),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS k FROM h),
p AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM g WHERE k > 1) q GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p USING (doc_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_symbols / greatest(word_chars, 1) AS symbol_rate, n_dup_lines / greatest(n_lines, 1) AS dup_line_rate, n_repeat_words / greatest(n_words, 1) AS repeat_rate, word_chars / greatest(n_words, 1) AS word_length FROM m),
o AS ({_BREAKS('lang, source, ')} GROUP BY lang, source), l AS ({_BREAKS('lang, ')} GROUP BY lang), a AS ({_BREAKS('')}),
b AS (SELECT o.lang, o.source, {', '.join(f'{_BOUND(c, low)} AS {c}_{low}' for c, low in _SIDES)} FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(symbol_rate <= symbol_rate_0 AND dup_line_rate <= dup_line_rate_0 AND repeat_rate <= repeat_rate_0 AND word_length <= word_length_0 AND word_length >= word_length_1, true) AS kept
FROM r LEFT JOIN b ON r.lang IS NOT DISTINCT FROM b.lang AND r.source IS NOT DISTINCT FROM b.source
"""
OP12 = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
f AS (SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m FROM w),
x AS (SELECT part, m, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND quality = 1)) AS g, count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND toxic = 1)) AS b FROM f GROUP BY part, m),
c AS (SELECT part, s, sum(CASE WHEN m & s <> 0 THEN n ELSE 0 END) AS v, sum(CASE WHEN m & s <> 0 THEN g ELSE 0 END) AS vg, sum(CASE WHEN m & s <> 0 THEN b ELSE 0 END) AS vb, sum(n) AS total FROM x, (SELECT unnest(range(0, 32)) AS s) q GROUP BY part, s),
p AS (SELECT '' AS o, 0 AS s, 0 AS before, 0 AS own UNION ALL SELECT o || l, s + b, s, b FROM p, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) q(l, b) WHERE s & b = 0),
r AS (SELECT z.part, w.o AS filter_order, length(p.o) AS step, p.own, z.total - z.v AS kept, z.v - a.v AS removed, i.v - (z.v - a.v) AS redundant, e.v - r.v AS unique_fails, z.vg - a.vg AS good_lost, z.vb - a.vb AS toxic_lost
  FROM (SELECT o FROM p WHERE length(o) = 5) w JOIN p ON starts_with(w.o, p.o) AND p.o <> '' JOIN c z ON z.s = p.s JOIN c a ON a.part = z.part AND a.s = p.before JOIN c i ON i.part = z.part AND i.s = p.own JOIN c e ON e.part = z.part AND e.s = 31 JOIN c r ON r.part = z.part AND r.s = 31 - p.own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_adaptive_quality": OP3, "op12_exact_shapley": OP12, "op2_vector_graph": OP2, "op7_minhash_forest": OP7, "op8_digest_array": OP8, "op9_chat_grammar": OP9}
