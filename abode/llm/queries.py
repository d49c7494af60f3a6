"""Registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.llm import audit, bpe, collocations, decontam, exactdup, hilbert, langid, linecrf, markov, neardup, passages, pii, urlglob

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    urlglob.host_rule("allow", "org/"),
    urlglob.host_rule("block", "example.org/es/"),
    urlglob.host_rule("block", "example.org/en/1"),
    urlglob.host_rule("allow", "com/fr/"),
    urlglob.host_rule("block", "com/de/"),
]


def tokenizer_path() -> str:
    """The public tokenizer file of the queries; installed beside Python on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_hd_langid(spark, sf_dir):
    return langid.predict_languages(documents(spark, sf_dir))


def op2_url_automaton(spark, sf_dir):
    return urlglob.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op3_chained_passages(spark, sf_dir):
    return passages.shared_passages(documents(spark, sf_dir))


def op4_fss_near_dedup(spark, sf_dir):
    return neardup.near_groups(documents(spark, sf_dir))


def op5_tree_bpe(spark, sf_dir):
    ids = bpe.encode_texts(documents(spark, sf_dir), tokenizer_path())
    return bpe.token_report(ids, tokenizer_path())


def op6_hilbert_shards(spark, sf_dir):
    placed = hilbert.hilbert_shards(documents(spark, sf_dir), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_markov_secrets(spark, sf_dir):
    return markov.secret_report(documents(spark, sf_dir))


def op8_tree_exact_dedup(spark, sf_dir):
    return exactdup.exact_groups(documents(spark, sf_dir), keep="max")


def op9_pigeonhole_decontam(spark, sf_dir):
    return decontam.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_pii_spans(spark, sf_dir):
    return pii.pii_report(documents(spark, sf_dir))


def op11_tiled_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


def op12_line_crf(spark, sf_dir):
    return linecrf.quality_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_retraction_audit(spark, sf_dir):
    return audit.filter_audit(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP2_SQL = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
best AS (
  SELECT p.r, rules.host || rules.path AS rule, rules.verdict,
         row_number() OVER (PARTITION BY p.r ORDER BY length(rules.host || rules.path) DESC, rules.host || rules.path) AS k
  FROM parts p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.r = b.r AND b.k = 1
"""

OP4_SQL = """
WITH RECURSIVE
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, w.doc_id = comp.component_id AS kept
FROM w JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP8_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT t.doc_id, g.keep_id, g.group_size,
       t.doc_id IS NOT DISTINCT FROM g.keep_id AND row_number() OVER (PARTITION BY t.h, t.doc_id) = 1 AS kept,
       t.h AS text_sha256
FROM t JOIN g USING (h)
"""

OP11_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, s.k, unnest(list_transform(range(1, len(ws) - s.k + 2), lambda i: array_to_string(ws[i:i + s.k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) s WHERE len(ws) >= s.k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, i, array_to_string(ws[1:i], ' ') AS head, array_to_string(ws[i + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a) // (x.a + y.a) AS score,
         row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY (2000000::HUGEINT * cuts.a) // (x.a + y.a), i) AS pick
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.head JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.tail),
inner_ AS (
  SELECT lang, a, array_to_string(ws[i:j], ' ') AS phrase
  FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c)) WHERE j - i + 1 < k),
covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_ ON c.lang = inner_.lang AND c.phrase = inner_.phrase
  WHERE 100 * inner_.a >= 80 * c.a),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s ANTI JOIN covered ON s.lang = covered.lang AND s.phrase = covered.phrase WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

OP13_SQL = """
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
least AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
w AS (
  SELECT d.*, regexp_extract_all(d.t, '[^\\x20\\x09-\\x0D]+') AS words, coalesce(d.doc_id > least.first, false) AS later,
         coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM d JOIN least ON d.t = least.t LEFT JOIN l ON d.doc_id = l.doc_id),
fails AS (
  SELECT part, good, toxic,
         concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN later THEN 'E' ELSE '' END) AS f
  FROM w),
c AS (SELECT part, good, toxic, f, count(*) AS n FROM fails GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
orders AS (
  SELECT concat(a.k, b.k, c.k, d.k, e.k) AS o FROM x a JOIN x b ON b.k <> a.k JOIN x c ON c.k NOT IN (a.k, b.k)
  JOIN x d ON d.k NOT IN (a.k, b.k, c.k) JOIN x e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
steps AS (
  SELECT o, s.step, substr(o, s.step, 1) AS own, substr(o, 1, s.step - 1) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
seen AS (
  SELECT c.*, o, step, own, contains(f, own) AS here, earlier <> '' AND translate(f, earlier, '') <> f AS gone FROM c, steps),
sums AS (
  SELECT part, o AS filter_order, step, any_value(own) AS own,
         coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (f = own), 0) AS unique_fails,
         coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0) AS toxic_lost
  FROM seen GROUP BY part, o, step)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM sums
"""


def queries() -> dict[str, Query]:
    return {
        "op1_hd_langid": op1_hd_langid,
        "op2_url_automaton": op2_url_automaton,
        "op3_chained_passages": op3_chained_passages,
        "op4_fss_near_dedup": op4_fss_near_dedup,
        "op5_tree_bpe": op5_tree_bpe,
        "op6_hilbert_shards": op6_hilbert_shards,
        "op7_markov_secrets": op7_markov_secrets,
        "op8_tree_exact_dedup": op8_tree_exact_dedup,
        "op9_pigeonhole_decontam": op9_pigeonhole_decontam,
        "op10_pii_spans": op10_pii_spans,
        "op11_tiled_collocations": op11_tiled_collocations,
        "op12_line_crf": op12_line_crf,
        "op13_retraction_audit": op13_retraction_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_fss_near_dedup": OP4_SQL,
        "op2_url_automaton": OP2_SQL,
        "op8_tree_exact_dedup": OP8_SQL,
        "op11_tiled_collocations": OP11_SQL,
        "op13_retraction_audit": OP13_SQL,
    }
