"""The registered queries of the training-data operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bloom_cascade, centroids, chat_template, compression_quality, ctw, decontaminate, langid, license_scan, minhash_dedup, mixing, outliers, whitening
from .common import finished, read


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op1", lambda: bloom_cascade.filter_urls(read(spark, sf_dir, "pages"), bloom_cascade.rules_table(spark)))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_template.read_back(chat_template.format_conversations(chat_template.with_probe(read(spark, sf_dir, "conversations"))))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op3", lambda: ctw.documents_scored(read(spark, sf_dir, "documents")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.documents_identified(read(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op5", lambda: minhash_dedup.near_duplicates(read(spark, sf_dir, "documents")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op7", lambda: mixing.mix(read(spark, sf_dir, "documents"), mixing.WEIGHTS))


def op8_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = audio.media_columns(read(spark, sf_dir, "documents"))
    return m.select(
        "doc_id", "n_bytes", F.length("samples").cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(samples, -16, 16)")).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), F.sha2("tensors", 256).alias("feature"), F.size("segments").alias("n_segments"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = lambda: compression_quality.documents_rated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return finished(spark, "op9", lambda: rated().select("doc_id", "held_out", "score", "predicted"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")
    judged = lambda: decontaminate.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return finished(spark, "op10", lambda: judged().select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op11", lambda: centroids.clustered(read(spark, sf_dir, "embeddings")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return finished(spark, "op12", lambda: outliers.judged(read(spark, sf_dir, "documents")).select(*columns))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, "op13", lambda: whitening.whitened(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long")))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_chat_formatting, op3_lm_scoring, op4_language_id, op5_near_dedup, op6_license_scan, op7_source_mixing, op8_audio_features, op9_quality_classifier, op10_decontamination, op11_centroid_clustering, op12_quality_rules, op13_embedding_whitening)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _level(d: int) -> str:
    """The shares of the tree's level d among the children of each node, in closed form."""
    path, up = mixing.TREE[:d], mixing.TREE[: d - 1]
    cols, of, on = ", ".join(path), ", ".join(["top", *up]), " AND ".join(f"c.{x} = u.{x}" for x in ["top", *up])
    weight = "".join(f" WHEN {' AND '.join(f"{c} = '{v}'" for c, v in zip(path, k, strict=True))} THEN {w}" for k, w in mixing.WEIGHTS.items() if len(k) == d)
    weight = f"CASE{weight} ELSE 1.0 END::DOUBLE" if weight else "1.0::DOUBLE"
    return f"""
c{d} AS (SELECT top, {cols}, sum(held) * {float(mixing.MAX_EPOCHS)}::DOUBLE AS capacity, {weight} AS weight FROM leaves GROUP BY ALL),
l{d} AS (SELECT c.*, greatest(u.share - coalesce(sum(capacity) OVER (PARTITION BY {", ".join("c." + x for x in ["top", *up])} ORDER BY capacity / weight, c.{path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0)
  / sum(weight) OVER (PARTITION BY {", ".join("c." + x for x in ["top", *up])} ORDER BY capacity / weight, c.{path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c{d} c JOIN s{d - 1} u ON {on}),
s{d} AS (SELECT top, {cols}, CASE WHEN capacity <= level * weight THEN capacity ELSE max(CASE WHEN capacity > level * weight THEN level END) OVER (PARTITION BY {of}) * weight END AS share FROM l{d})"""


def _round(r: int) -> str:
    """Assigns all vectors to the centroids c{r} and moves these; distances of integers are exact in doubles."""
    return f"""
a{r} AS MATERIALIZED (SELECT v.r, min({{'d': v.qq - 2 * list_inner_product(v.q, c.q) + c.qq, 'k': c.k}}) AS best FROM v, c{r} c GROUP BY v.r),
m{r} AS (SELECT k, list(x ORDER BY i) AS q FROM (SELECT best.k AS k, i, floor(sum(q[i]) / count(*)) AS x FROM a{r} JOIN v ON a{r}.r = v.r, range(1, {centroids.DIMS + 1}) t(i) GROUP BY 1, 2) GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.q, c.q) AS q, list_inner_product(coalesce(m.q, c.q), coalesce(m.q, c.q)) AS qq FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k),"""


_LAST = centroids.ROUNDS

ORACLE_SQL = {
    "op1_url_filter": f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0)")} AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled""",
    "op2_chat_formatting": r"""
WITH probe AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]', NULL), (-1, 1, 'assistant', '</s>[INST] ok [/INST]', NULL)),
sized AS (SELECT *, length(regexp_replace(replace(role, '\', '\\'), '(</?s>|\[/?INST\]|\[/?ROLE\])', '\1x', 'g')) AS r,
  length(regexp_replace(replace(text, '\', '\\'), '(</?s>|\[/?INST\]|\[/?ROLE\])', '\1x', 'g')) AS t FROM probe)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(13 + r + t + CASE WHEN role = 'assistant' THEN 4 ELSE 13 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id, alone""",
    "op5_near_dedup": rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS MATERIALIZED (SELECT w.doc_id, count(sh) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY ALL),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN m ON n.doc_id = m.doc_id""",
    "op7_source_mixing": rf"""
WITH r AS MATERIALIZED (SELECT doc_id, 'd' || (ascii(md5(coalesce(source, ''))) % 3) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaves AS MATERIALIZED (SELECT 0 AS top, domain, lang, source, sum(n_tokens)::BIGINT AS held FROM r GROUP BY ALL HAVING sum(n_tokens) > 0),
s0 AS (SELECT 0 AS top, sum(held) * {mixing.SHARE}::DOUBLE AS share FROM leaves),{_level(1)},{_level(2)},{_level(3)},
planned AS (SELECT domain, lang, source, held, floor(share + 1e-6)::BIGINT AS budget FROM leaves JOIN s3 USING (domain, lang, source)),
placed AS (SELECT doc_id, domain, lang, source, n_tokens, budget // held AS epochs, budget % held AS rest, md5('{mixing.SEED}:' || (budget // held) || ':' || doc_id) AS place FROM r JOIN planned USING (domain, lang, source) WHERE budget > 0),
taken AS (SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM placed)
SELECT * FROM taken WHERE copies > 0""",
    "op10_decontamination": rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, least(13, len(ws)) AS l, unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1), lambda i: array_to_string(ws[i:i + 12], ' '))) AS t FROM b WHERE len(ws) > 0),
run AS (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM win)),
hit AS MATERIALIZED (SELECT doc_id, i, run.l, item_id FROM run JOIN win ON run.l = win.l AND array_to_string(ws[i:i + run.l - 1], ' ') = t),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id""",
    "op11_centroid_clustering": f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, q, list_inner_product(q, q) AS qq FROM (
  SELECT vec_id, list_transform(embedding, lambda x: floor({centroids.UNIT} * x::DOUBLE)) AS q FROM embeddings
  WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS k, q, qq FROM v QUALIFY k < {centroids.K}),{"".join(map(_round, range(_LAST)))}
a AS MATERIALIZED (SELECT v.r, v.vec_id, min({{'d': v.qq - 2 * list_inner_product(v.q, c.q) + c.qq, 'k': c.k}}) AS best FROM v, c{_LAST} c GROUP BY v.r, v.vec_id)
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a JOIN c{_LAST} c ON c.k = a.best.k""",
}
