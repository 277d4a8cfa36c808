"""The registered query of each operator of this package, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import chat, decontaminate, divergence, fim, language, lm, mixing, near, pipeline, private, quality, repeats, urls
from martloom.llm.sample import held_out, learnable
from martloom.llm.topk import quantised, top_k

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    found = top_k(quantised(table(spark, folder, "embeddings")), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(learnable(5, 0)))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op3_private(spark: SparkSession, folder: str) -> DataFrame:
    return private.pseudonymised(table(spark, folder, "documents").select("doc_id", "text"))


def op4_near(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, folder, "benchmark"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs.filter(learnable(5, 0)), table(spark, folder, "labels").filter(learnable(5, 0)))
    found = quality.scored(docs, model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select(*columns).unionByName(added)
    records = rows.select("conv_id", "turn", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("payload"))
    return chat.digests(chat.formatted(chat.canonical_turns(records)))


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op10_katz(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", held_out(7, 2).alias("held_out"), "text")
    found = lm.scored(docs, learnable(7, 2))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    found = fim.filled_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    back = fim.restored(F.col("output"), F.col("form"))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents").select("text", "lang", "source"))


def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages").select("page_id", "url")).drop("url")


def queries() -> dict[str, Query]:
    return {
        "op1_topk": op1_topk,
        "op2_language": op2_language,
        "op3_private": op3_private,
        "op4_near": op4_near,
        "op5_decontaminate": op5_decontaminate,
        "op6_quality": op6_quality,
        "op7_chat": op7_chat,
        "op8_repeats": op8_repeats,
        "op9_mixing": op9_mixing,
        "op10_katz": op10_katz,
        "op11_fim": op11_fim,
        "op12_divergence": op12_divergence,
        "op13_urls": op13_urls,
        "pipeline": pipeline.run,
    }


OP1_SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP7_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
), sized AS (
    SELECT *, 15
        + length(text) + len(regexp_extract_all(text, '\\|</turn>'))
        + coalesce(list_sum([length(x) - 2 FOR x IN regexp_extract_all(text, '#{3,}')]), 0)
        + length(role) + len(regexp_extract_all(role, '[\\:\n]|</turn>'))
        + coalesce(list_sum([length(x) - 2 FOR x IN regexp_extract_all(role, '#{3,}')]), 0) AS chars
    FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


OP11_SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), numbered AS (
    SELECT *, len(lines) AS n,
           CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS c2,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS whether, CAST('0x' || h[25:32] AS BIGINT) % 100 AS which
    FROM drawn
), cut AS (
    SELECT *,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR whether >= 100 THEN 'plain'
                WHEN which < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(lines[1:least(c1, c2)], '') AS p,
           array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(lines[greatest(c1, c2) + 1:n], '') AS s
    FROM numbered
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
), words AS (
    SELECT id, lang, source,
           translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM docs
), kept AS (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), sizes AS (
    SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), used AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM words w SEMI JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS total FROM used GROUP BY lang, source
), cells AS (
    SELECT g.lang, g.source, k.term, CAST(coalesce(u.n, 0) AS HUGEINT) AS n,
           1 + 1000000000 * (CAST(coalesce(u.n, 0) AS HUGEINT) + 2) // (coalesce(t.total, 0) + 2 * z.v) AS p,
           1 + 1000000000 * (k.n + 2) // (z.total + 2 * z.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes z ON z.lang = g.lang
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM cells a JOIN cells b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
    GROUP BY a.lang, a.source, b.source
), every_pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), every_term AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
    FROM cells WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
    FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM every_term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


OP13_SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS id, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages
), bare AS (
    SELECT id, page_id, regexp_replace(coalesce(tail, ''), '(?s)[?#].*$', '') AS tail FROM split
), parts AS (
    SELECT id, page_id,
           translate(CASE WHEN strpos(tail, '/') > 0 THEN substr(tail, 1, strpos(tail, '/') - 1) ELSE tail END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           CASE WHEN strpos(tail, '/') > 0 THEN substr(tail, strpos(tail, '/')) ELSE '' END AS path
    FROM bare
), rules(verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting AS (
    SELECT id, arg_max({'rule': h || p, 'verdict': rules.verdict}, length(h || p)) AS best
    FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY id
), bad AS (
    SELECT id, regexp_matches('.' || host, '\.(spam|cheap)-|-(spam|pills)\.|casino') OR contains(path, '/wp-login.php') AND NOT regexp_matches(path, '/wp-login\.php[^/]*/')
           OR ends_with('.' || host || path, '.exe') OR ends_with('.' || host || path, '.apk') AS blocked
    FROM parts
)
SELECT page_id, host, path, f.best.rule AS rule, coalesce(f.best.verdict, CASE WHEN b.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fitting f USING (id) JOIN bad b USING (id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1_SQL, "op7_chat": OP7_SQL, "op11_fim": OP11_SQL, "op12_divergence": OP12_SQL, "op13_urls": OP13_SQL}
