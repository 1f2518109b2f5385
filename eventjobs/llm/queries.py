"""The registered queries of this subpackage and, where SQL can express them, the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import escape, format_chats, read_back, records_of_turns, unescape
from .minhash_dedup import Params, near_duplicates
from .decontaminate import judge_contamination
from .labelled import fold, sample
from .packing import Params as PackingParams
from .packing import pack_best_fit, pack_harmonic
from .quality import Params as QualityParams
from .quality import score_quality
from .quality import train as train_quality
from .recurrent import score_documents
from .repair import repair_damaged
from .toxicity import Params as ToxicityParams
from .toxicity import score_toxicity
from .toxicity import train as train_toxicity
from .substring_dedup import remove_repeats
from .topk import quantised, top_k
from .url_filter import judge_urls
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Params(shingle=4))


def op2_topk_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


#: The conversation that op6 adds: its texts are control strings of a common template.
ADDED = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.to_json(F.struct(F.lit(ADDED).alias("prompt"), F.lit(ADDED).alias("response"))).alias("record"))
    columns = ["conv_id", "formatted", "loss_spans"]
    done = format_chats(records_of_turns(rows)).select(*columns).union(format_chats(added).select(*columns))
    turns = read_back(F.col("formatted"))
    lost = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    done = done.select("conv_id", "formatted", turns.alias("back"), F.array_join(lost, "").alias("lost"))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


def packing_params() -> PackingParams:
    """Production parameters; the tokenizer's file is a public one that is installed beside the library."""
    import public_tokenizers

    return PackingParams(tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op8_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"), packing_params())


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_harmonic(table(spark, sf_dir, "documents"), packing_params(), with_ids=False)


def quality_model(spark: SparkSession, sf_dir: str):
    """Trained on the labels of the rows that op5 does not hold out."""
    p = QualityParams()
    return train_quality(sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", fold(F.col("doc_id"), 4) != 2, p.each), p)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = score_quality(documents, quality_model(spark, sf_dir), QualityParams())
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return done.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = ToxicityParams()
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(sample(documents, table(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 5) != 0, p.each), p)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    done = score_toxicity(documents, model, p)
    return done.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_contamination(documents, table(spark, sf_dir, "benchmark")).drop("text")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A long holds the deviation of vectors of unit length up to some millions of them; beyond it is null here, and whole in the operator's decimal.
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 5) != 1)
    return done.select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_topk_impact": op2_topk_impact,
        "op6_chat_format": op6_chat_format,
        "op3_toxicity": op3_toxicity,
        "op4_decontaminate": op4_decontaminate,
        "op5_quality": op5_quality,
        "op8_token_matrix": op8_token_matrix,
        "op9_harmonic_packing": op9_harmonic_packing,
        "op7_substring_dedup": op7_substring_dedup,
        "op10_url_filter": op10_url_filter,
        "op11_whitening": op11_whitening,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_recurrent_lm": op13_recurrent_lm,
        "pipeline": pipeline,
    }


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM words),
uniq AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS x FROM uniq),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
near AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(a, b) AS (SELECT rep, rep FROM uniq UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
named AS (SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
  FROM sets d LEFT JOIN uniq u ON list_sort(d.s) = u.s AND len(d.s) > 0 LEFT JOIN comp c ON c.rep = u.rep)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM named
"""

OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP6_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS lost,
    sum(11 + length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(lost) AS BIGINT) AS loss_chars,
  sha256(lost) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM c
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM rep)),
ws AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT ws.doc_id, string_agg(x, ' ' ORDER BY ws.j) AS k, count(*) AS n FROM ws ANTI JOIN gone ON ws.doc_id = gone.doc_id AND ws.j = gone.j GROUP BY ws.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, s, action) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block'))
SELECT page_id, host, path, arg_max(h || s, length(h || s)) AS rule, coalesce(arg_max(action, length(h || s)), 'allow') AS verdict
FROM (SELECT row_number() OVER () AS n, * FROM p) LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
GROUP BY n, page_id, host, path
"""


OP12_SQL = r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
sums AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))), 4294967295::BIGINT) % 20 AS what FROM base),
damaged AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy FROM sums WHERE what <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM damaged),
turns AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
follows(role, i, j) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
inserts(i, j, cost, edits) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (1, 2, 5, 'I'), (3, 2, 5, 'I'), (2, 3, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')),
done AS (
  SELECT DISTINCT t.initial, t.fault, e.i, e.j, e.cost + CASE WHEN t.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost, e.edit FROM turns t, (
    SELECT i, j, role, 0 AS cost, 'K' AS edit FROM follows UNION ALL SELECT i, j, NULL, 1, 'R' FROM follows WHERE role <> 's' UNION ALL SELECT x, x, NULL, 2, 'D' FROM (SELECT unnest(range(4)) AS x)) e
  WHERE (e.edit <> 'K' OR e.role = t.initial) AND (e.edit = 'D' OR t.fault IN ('', 'truncated'))),
best(conv_id, n, state, b) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': ''} FROM turns
  UNION ALL
  SELECT p.conv_id, p.n + 1, d.j, min({'cost': p.b.cost + x.cost + d.cost, 'audit': p.b.audit || x.edits || d.edit})
  FROM best p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.n + 1 JOIN inserts x ON x.i = p.state JOIN done d ON d.initial = t.initial AND d.fault = t.fault AND d.i = x.j GROUP BY ALL),
counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id),
chosen AS (
  SELECT c.conv_id, min({'cost': p.b.cost + x.cost, 'audit': p.b.audit || x.edits}) AS b FROM counts c JOIN best p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.n = c.n JOIN inserts x ON x.i = p.state AND x.j IN (0, 3) GROUP BY ALL),
edits AS (SELECT conv_id, unnest(range(1, length(b.audit) + 1)) AS p, b.audit AS audit FROM chosen),
lines AS (
  SELECT e.conv_id, p, substr(audit, p, 1) AS edit, t.role, t.text, p - 1 - length(regexp_replace(substr(audit, 1, p - 1), '[^D]', '', 'g')) AS line
  FROM (SELECT *, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM edits) e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.i = e.i AND substr(audit, p, 1) <> 'I' WHERE substr(audit, p, 1) <> 'D'),
said AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line - begins) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(CASE WHEN edit <> 'I' THEN text END, ''), chr(10) ORDER BY p) AS repaired
  FROM (SELECT *, max(CASE WHEN line = 0 AND edit = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS begins FROM lines) GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(c.b.cost, 0) AS BIGINT) AS cost, coalesce(c.b.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts USING (conv_id) LEFT JOIN chosen c USING (conv_id) LEFT JOIN said USING (conv_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": OP1_SQL,
        "op2_topk_impact": OP2_SQL,
        "op6_chat_format": OP6_SQL,
        "op7_substring_dedup": OP7_SQL,
        "op10_url_filter": OP10_SQL,
        "op12_conversation_repair": OP12_SQL,
    }
