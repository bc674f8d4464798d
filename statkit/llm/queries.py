"""The subpackage's registered queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact_dup, langid, leaks, licences, merkle, mixing, near_dup, packing, pii, quality, topk, whitening
from .common import table

MIX_WEIGHTS = [5.0, 2.0, 1.0]
ODD_TURN = "</s>[INST] ok [/INST]"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents")).drop("detections")


def op2_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return langid.identify_languages(table(spark, sf_dir, "documents"), held_out)


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.pareto_mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, share=1.5, most=2.0)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85, bands=24, rows=4)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"), F.lit(ODD_TURN).alias("text"))
    return chat.read_back(chat.chat_examples(turns.unionByName(odd)))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0, k=10)


def op9_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "text_score", "page_score", "score", (F.col("score") >= 0.5).alias("kept"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.shown("base").cast("binary"), 256).alias("base_sha256"), pii.shown("redactions").alias("spans"))


def op11_lanczos_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=8)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    offered = merkle.leaf_digest(*[more if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    made = merkle.manifest(docs, load=F.struct("doc_id", F.when(tampered, offered).alias("offered")))
    rows = merkle.proofs(made).withColumn("folded", merkle.folded(F.col("path"), F.coalesce("load.offered", "digest")))
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    return rows.select(
        "load.doc_id", merkle.shown(F.col("digest")).alias("leaf"), merkle.shown(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(merkle.proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), merkle.shown(F.col("folded")).alias("folded_root"),
        (merkle.shown(F.col("folded")) == root).alias("verified"),
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_best_fit_pack": op2_best_fit_pack,
    "op3_language_id": op3_language_id,
    "op4_pareto_mix": op4_pareto_mix,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_mtree_topk": op8_mtree_topk,
    "op9_cotrain_quality": op9_cotrain_quality,
    "op10_pii": op10_pii,
    "op11_lanczos_whiten": op11_lanczos_whiten,
    "op12_decontaminate": op12_decontaminate,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_SHOWN = "length({0}) + length({0}) - length(replace({0}, chr(92), ''))"
for _control in chat.CONTROL:
    _SHOWN += f" + (length({{0}}) - length(replace({{0}}, '{_control}', ''))) // {len(_control)}"

ORACLE = {
    "op8_mtree_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_minhash_near_dedup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op6_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{ODD_TURN}' UNION ALL SELECT -1, 1, 'assistant', '{ODD_TURN}'),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum({len(chat.START + chat.SEP + chat.END)} + {_SHOWN.format('role')} + {_SHOWN.format('text')}) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM t)
SELECT conv_id, max(n)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op12_decontaminate": """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
g AS (
  SELECT item_id, least(len(ws), 10) AS k, ws[i : i + least(len(ws), 10) - 1] AS gram
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
s AS (SELECT r, ws[i : i + k - 1] AS gram, i, k FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g))),
h AS (SELECT s.r, s.i, s.k, g.item_id FROM s JOIN g ON s.gram = g.gram),
n AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""",
    "op13_merkle_manifest": """
WITH RECURSIVE bits AS (  -- crc32 of the decimal doc_id, a bit at a time
  SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::BIGINT) ELSE c END AS x FROM bits WHERE k < 8 * len(s))),
crc AS (SELECT doc_id, xor(c, 4294967295) AS crc FROM bits WHERE k = 8 * len(s)),
f AS (
  SELECT lang, doc_id, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
l AS (
  SELECT lang, f.doc_id, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END)::VARCHAR) || ':' || (n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END), '-') || tail) AS offered
  FROM f LEFT JOIN crc ON crc.doc_id = f.doc_id),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
nodes AS (
  SELECT tree, 0 AS level, i, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, i // 2),
depth AS (SELECT tree, max(level) AS depth FROM nodes GROUP BY tree),
subroots AS (SELECT tree, digest FROM nodes JOIN depth USING (tree) WHERE level = depth),
tops AS (
  SELECT 0 AS level, tree AS i, digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, i // 2),
height AS (SELECT max(level) AS height FROM tops),
every AS (  -- the levels of all trees below those of the tree of subroots
  SELECT tree, level, i, digest FROM nodes JOIN depth USING (tree) WHERE level < depth
  UNION ALL SELECT tree, depth + level, i, digest FROM tops, depth, height WHERE level < height),
way AS (
  SELECT x.tree, x.i AS leaf_i, s.level, CASE WHEN s.level < depth THEN x.i >> s.level ELSE x.tree >> (s.level - depth) END AS own
  FROM leaves x JOIN depth USING (tree), height, (SELECT unnest(range(0, 80)) AS level) s WHERE s.level < depth + height),
siblings AS (
  SELECT w.tree, w.leaf_i, w.level, w.own, e.digest FROM way w LEFT JOIN every e ON e.tree = w.tree AND e.level = w.level AND e.i = xor(w.own, 1)),
proof AS (SELECT tree, leaf_i, string_agg(digest, '' ORDER BY level) AS proof, max(level) + 1 AS levels FROM siblings GROUP BY tree, leaf_i),
fold AS (
  SELECT tree, i AS leaf_i, 0 AS level, offered AS digest FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_i, f.level + 1, sha256(CASE WHEN s.own % 2 = 1 THEN s.digest || f.digest ELSE f.digest || coalesce(s.digest, '') END)
  FROM fold f JOIN siblings s ON s.tree = f.tree AND s.leaf_i = f.leaf_i AND s.level = f.level)
SELECT doc_id, leaf, subroots.digest AS subroot, (SELECT digest FROM tops, height WHERE level = height) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  fold.digest AS folded_root, fold.digest = (SELECT digest FROM tops, height WHERE level = height) AS verified
FROM leaves JOIN subroots USING (tree) LEFT JOIN proof ON proof.tree = leaves.tree AND proof.leaf_i = leaves.i
JOIN fold ON fold.tree = leaves.tree AND fold.leaf_i = leaves.i AND fold.level = coalesce(proof.levels, 0)""",
}
