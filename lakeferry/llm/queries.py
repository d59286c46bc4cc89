"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary, chat, decontam, langid, mixing, separators, simhash, topk, toxicity, warc
from .common import held_out, remove, table, work_dir

END_OF_DOCUMENT = 49407


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 3, 1)
    return langid.predict(docs, langid.train(docs, ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.score(docs, toxicity.train(docs, labels, toxicity.usable_for_training()))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", predicted.alias("predicted"), F.size("spans").cast("bigint").alias("n_offending"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file, doc_no, start, n_tokens, ended: what the scan finds, beside the ids that the writer has put there."""
    folder = work_dir(spark, "flat")
    wrote, width = separators.write_flat(table(spark, sf_dir, "documents"), tokenizer(), folder, END_OF_DOCUMENT)
    found = separators.scan(spark, folder, END_OF_DOCUMENT, width)
    remove(spark, folder)
    return found.join(wrote, ["file", "doc_no"], "full").select("doc_id", "file", "doc_no", "start", "n_tokens", "ended")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    out = warc.archive(spark, table(spark, sf_dir, "pages"), folder)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-7).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    return chat.digests(chat.read_back(chat.windows(turns.union(probe))))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "binary")
    binary.write(table(spark, sf_dir, "documents"), folder, tokenizer())
    return binary.read(spark, folder)


QUERIES = {f.__name__: f for f in (op1_top_k, op2_decontaminate, op3_language, op4_toxicity, op5_token_counts, op6_mixing, op7_warc, op8_chat, op9_simhash, op10_token_ids)}

ORACLES = {
    "op8_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) x(i)),
e AS (SELECT *, coalesce(turn >> 7, -9223372036854775808) AS part, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
        9 + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, chr(10), '')) + len(regexp_extract_all(role || ' ' || text, '</?s>|\[/?INST\]|<</?SYS>>')) + length(text) - length(replace(text, '\', '')) AS more FROM t),
p AS (SELECT *, nth = 1 AND role = 'system' AS sys, length(role) + length(text) + more AS chars, strlen(role) + strlen(text) + more AS n FROM e),
o AS (SELECT *, max(CASE WHEN sys THEN n ELSE 0 END) OVER (PARTITION BY conv_id) AS s, max(CASE WHEN sys THEN chars ELSE 0 END) OVER (PARTITION BY conv_id) AS s_chars,
        CASE WHEN sys THEN 0 ELSE n END AS own, sum(CASE WHEN sys THEN 0 ELSE n END) OVER (PARTITION BY conv_id, part ORDER BY nth) AS after FROM p),
r AS (SELECT *, after - own AS before, greatest(1, 3072 - s) AS stride FROM o),
v AS (SELECT *, 2 * (before // stride) + CASE WHEN after > (before // stride + 1) * stride THEN 1 ELSE 0 END AS w FROM r),
g AS (SELECT conv_id, part, w, before, chars FROM v WHERE NOT sys
      UNION ALL SELECT conv_id, part + 1, -1, -sum(n) OVER (PARTITION BY conv_id, part ORDER BY nth DESC), chars FROM v WHERE NOT sys AND (turn & 127) >= 120),
f AS (SELECT conv_id, part, w, sum(chars) AS chars, max(s) AS s, max(s_chars) AS s_chars, bool_or(sys) AS has, sum(own) AS own, min(CASE WHEN sys THEN 0 ELSE before END) AS opens,
        coalesce(lag(w) OVER (PARTITION BY conv_id, part ORDER BY w), -1) AS past FROM v GROUP BY conv_id, part, w),
b AS (SELECT f.conv_id, f.part, f.w, sum(g.chars) AS chars FROM f JOIN g ON f.conv_id IS NOT DISTINCT FROM g.conv_id AND f.part = g.part AND f.past = g.w
      WHERE g.before >= f.opens - greatest(0, least(1024, 4096 - f.s - f.own)) GROUP BY ALL),
c AS (SELECT f.conv_id, CAST(sum(f.chars + coalesce(b.chars, 0) + CASE WHEN has THEN 0 ELSE s_chars END) AS BIGINT) AS formatted_chars
      FROM f LEFT JOIN b ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.part = b.part AND f.w = b.w GROUP BY f.conv_id),
d AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS loss FROM e GROUP BY conv_id)
SELECT d.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM d JOIN c ON d.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op2_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS txt
      FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS s FROM b WHERE len(ws) > 0)),
p AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n),
m AS (SELECT doc_id, item_id, s, p.n FROM p JOIN w ON p.n = w.n AND array_to_string(ws[s:s + p.n - 1], ' ') = w.txt),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op1_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce('=' || source, '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM d GROUP BY source),
l AS (SELECT *, 2.0::DOUBLE * n AS cap, (sum(n) OVER () * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * n) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS (SELECT *, coalesce(least(cap, max(level) FILTER (level <= cap / w) OVER () * w), cap) AS target FROM l),
b AS (SELECT d.*, n, target, CAST(floor(target) AS BIGINT) AS budget, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target, CAST(budget // greatest(n, 1) * size + least(size, greatest(0, budget % greatest(n, 1) - before)) AS BIGINT) AS taken FROM b""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, sha256(html) AS s FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY s, n >= 100) END AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, true AS intact FROM f""",
}
