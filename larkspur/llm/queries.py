"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, common, decontamination, divergence, language_id, language_model, mixing, near_dedup, nearest, packing, quality, sharding, token_counts, url_filter

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("__key")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (remainder(10) == 0).alias("held_out"))
    return language_model.score(docs, language_model.train(docs.where(~F.col("held_out"))), ["doc_id", "held_out"], trained=~F.col("held_out"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = common.table(quality.measured(read(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]))
    held_out = remainder(5) == 0
    model = quality.train(stats.where(~held_out), read(spark, sf_dir, "labels"))
    scored = quality.score(stats, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_key", "keep")


def remainder(modulus: int) -> Column:
    """crc32(doc_id as text) mod `modulus`; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.Vocabulary.from_sentencepiece(os.environ.get("LARKSPUR_UNIGRAM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model"))
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary, ["doc_id"])


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    refs = language_id.references(docs.where(remainder(3) != 1))
    marked = language_id.identify(docs, refs, ["doc_id"])
    return marked.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = os.environ.get("LARKSPUR_PACKING_TOKENIZER", public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(read(spark, sf_dir, "documents"), path, ["doc_id"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_mixing, op3_lm_scoring, op4_quality, op5_url_filter, op6_sharding, op7_near_dedup, op8_token_counts, op9_nearest, op10_language_id,
        op11_collocations, op12_divergence, op13_packing,
    )
}

_WORDS = "SELECT {id} AS id, list_filter(regexp_split_to_array(lower(text), '[\\x00-/:-@\\[-`{{-\\x7F]+'), lambda x: x <> '') AS words FROM {table}"
_SHINGLES = """
  SELECT DISTINCT id, words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3] || ' ' || words[i+4] AS s
  FROM (SELECT id, words, unnest(range(1, len(words) - 3)) AS i
        FROM (SELECT {id} AS id, list_filter(regexp_split_to_array(lower(text), '[\\x00-/:-@\\[-`{{-\\x7F]+'), lambda x: x <> '') AS words FROM {table}))
"""

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
n AS (SELECT id, count(*) AS item_shingles FROM b GROUP BY id),
m AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM d JOIN b USING (s) GROUP BY 1, 2),
w AS ({_WORDS.format(id="doc_id", table="documents")}),
x AS (SELECT DISTINCT id, array_to_string(words, ' ') AS s FROM ({_WORDS.format(id="item_id", table="benchmark")}) WHERE len(words) > 0 AND id IS NOT NULL AND id NOT IN (SELECT id FROM b WHERE id IS NOT NULL)),
r AS (SELECT id, unnest(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i+2], ' '))) AS s FROM w UNION SELECT id, unnest(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' '))) FROM w
  UNION SELECT id, array_to_string(words, ' ') FROM w WHERE len(words) IN (1, 2)),
y AS (SELECT r.id AS doc_id, x.id AS item_id, count(*) AS shared FROM r JOIN x USING (s) GROUP BY 1, 2),
z AS (SELECT id, count(*) AS item_shingles FROM x GROUP BY id)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
FROM (SELECT * FROM m JOIN n ON n.id = item_id UNION ALL SELECT * FROM y JOIN z ON z.id = item_id) WHERE shared >= 0.8 * item_shingles - 1e-9""",
    # components as a recursive closure over the links of the pages; dot segments, <base> and rarer entities are in the tests alone
    "op5_url_filter": r"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
p AS (SELECT page_id, html, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*[^?#]*(\?[^#]*)?', 1), '') AS q FROM pages),
own AS (SELECT page_id, arg_max(rhost || rpath, len(rhost || rpath)) AS rule, arg_max(verdict, len(rhost || rpath)) AS own FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
t AS (SELECT host, path, host || path || q AS a, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM p WHERE host <> ''),
g AS (SELECT host, path, a, replace(CASE WHEN regexp_matches(tag, '(?is)^<link\b.*rel\s*=\s*(["''][^"'']*\bcanonical\b|canonical\b)') THEN regexp_extract(tag, '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1)
  WHEN regexp_matches(tag, '(?is)^<meta\b.*http-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?is)content\s*=\s*["'']?\s*\d*\s*[;,]\s*url\s*=\s*["'']?([^"''\s>]+)', 1) END, '&amp;', '&') AS dest FROM t),
f AS (SELECT a, CASE WHEN contains(dest, '://') THEN dest WHEN starts_with(dest, '//') THEN 'x:' || dest WHEN starts_with(dest, '/') THEN 'x://' || host || dest WHEN starts_with(dest, '?') THEN 'x://' || host || path || dest
  WHEN NOT starts_with(dest, '#') THEN 'x://' || host || coalesce(nullif(regexp_extract(path, '^.*/'), ''), '/') || dest END AS u FROM g WHERE dest <> ''),
e AS (SELECT DISTINCT a, b FROM (SELECT a, lower(regexp_extract(u, '://([^/?#]*)', 1)) || regexp_extract(u, '://[^/?#]*([^#]*)', 1) AS b FROM f WHERE u IS NOT NULL) WHERE a <> b AND b <> ''),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT a, a FROM s UNION SELECT r.a, s.b FROM r JOIN s ON r.b = s.a),
c AS (SELECT r.a, min(r.b) AS root, bool_or(coalesce(v.verdict, '') = 'block') AS blocked FROM r LEFT JOIN (
  SELECT n, arg_max(verdict, len(rhost || rpath)) AS verdict FROM (SELECT DISTINCT b AS n FROM r) JOIN rules ON (split_part(regexp_replace(n, '[?/]', ' '), ' ', 1) = rhost OR ends_with(split_part(regexp_replace(n, '[?/]', ' '), ' ', 1), '.' || rhost))
  AND starts_with(regexp_extract(n, '^[^/?]*([^?]*)', 1), rpath) GROUP BY n) v ON v.n = r.b GROUP BY r.a)
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, root AS alias_of FROM p LEFT JOIN own USING (page_id) LEFT JOIN c ON c.a = host || path || q""",
    "op11_collocations": r"""
WITH w0 AS (SELECT coalesce(lang, 'und') AS lang, doc_id, list_transform(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'), lambda p: regexp_extract_all(p, '[^\x20\x09]+')) AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS w FROM w0), q AS (SELECT lang, w FROM p WHERE len(w) > 0),
f1 AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM q) GROUP BY 1, 2), tot AS (SELECT lang, sum(f)::bigint AS n FROM f1 GROUP BY 1),
f2 AS (SELECT lang, g AS phrase, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM q) GROUP BY 1, 2 HAVING count(*) >= 10),
f3 AS (SELECT lang, g AS phrase, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM q) GROUP BY 1, 2 HAVING count(*) >= 10),
s3 AS (SELECT lang, phrase, f, split_part(phrase, ' ', 1) AS a1, split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3) AS b1, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS a2, split_part(phrase, ' ', 3) AS b2 FROM f3),
c AS (SELECT lang, phrase, f AS a, 1 AS k, split_part(phrase, ' ', 1) AS x, split_part(phrase, ' ', 2) AS y FROM f2 UNION ALL SELECT lang, phrase, f, 1, a1, b1 FROM s3 UNION ALL SELECT lang, phrase, f, 2, a2, b2 FROM s3),
u AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2),
z AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, (1000000::hugeint * a * a // (l.f::hugeint * r.f))::bigint AS score FROM c JOIN u l ON l.lang = c.lang AND l.phrase = x JOIN u r ON r.lang = c.lang AND r.phrase = y),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM z),
d AS (SELECT f2.lang, f2.phrase FROM f2 JOIN (SELECT lang, a2 AS g, f FROM s3 UNION ALL SELECT lang, b1, f FROM s3) t ON t.lang = f2.lang AND g = f2.phrase AND 100 * t.f >= 50 * f2.f),
v AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::int AS rank, phrase, a, l, r, score FROM b WHERE o = 1 AND (lang, phrase) NOT IN (SELECT lang, phrase FROM d))
SELECT lang, rank, phrase, a, l, r, n, score FROM v JOIN tot USING (lang) WHERE rank <= 2000""",
    "op12_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT lang, source, i, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 30),
v AS (SELECT l.lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept USING (lang) GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
full_ AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT f.lang, f.source, f.term, f.n, 1 + 1000000000::hugeint * (f.n + 5) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 5 * v.v) AS p FROM full_ f JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + 1000000000::hugeint * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * v.v) AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p.p > q.q),
r AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term)
SELECT * FROM (SELECT lang, source, part, item, value::bigint AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank FROM r) WHERE part = 'pair' OR rank <= 50""",
}
