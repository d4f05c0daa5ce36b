"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe_count import count_tokens
from .decontaminate import find_leaks
from .fill_middle import fill_in_middle, restore_texts
from .html_text import extract_pages
from .language_crf import predict_language, train_language
from .merkle import fold, leaf_digest, merkle_manifest, siblings
from .ngram_join import ngram_jaccard_classes
from .pii_feistel import pseudonymise
from .quality_gam import score_quality, train_quality
from .sentencepiece_codec import encode_documents
from .spot_classes import spot_classes
from .spotsigs import fingerprint_documents
from .tool_chat import CHAT_TOOLS, calls_from_chat, link_tool_calls, messages_from_chat
from .toxicity import score_toxicity, train_toxicity

#: The key of the pseudonyms that the queries make. Give a secret one in use.
KEY = "tessera"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_classes(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, _table(spark, sf_dir, "labels")))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprint_documents(docs, classes=spot_classes(docs))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = _table(spark, sf_dir, "conversations")
    calls, results = calls_from_chat(chat)
    return link_tool_calls(calls, results, CHAT_TOOLS).unionByName(messages_from_chat(chat))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restore_texts(fill_in_middle(_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    row = lambda n_chars: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = docs.select("doc_id", "lang", row(F.col("n_chars")).alias("leaf"),
                         F.when(tampered, row(F.col("n_chars") + 1)).alias("tampered"))
    out = merkle_manifest(leaves, carry=["tampered"])
    out = out.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return predict_language(docs, train_language(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_spotsigs": op3_spotsigs,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_pii": op8_pii,
    "op9_html_extraction": op9_html_extraction,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language_id": op13_language_id,
}
#: Exact Jaccard over all pairs that share a shingle, then everything reachable.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON r.doc_id = e.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM documents d JOIN r ON d.doc_id = r.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""
#: Cuts and forms from the digest of the id; the text is rebuilt from the output by its markers.
OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, t[1:a] AS pre, t[a + 1:b] AS mid, t[b + 1:n] AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                          ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS o FROM p),
w AS (SELECT *, strpos(o, '<P>') AS ip, strpos(o, '<S>') AS is_, strpos(o, '<M>') AS im, length(o) AS len FROM o)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars, sha256(o) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN o[ip + 3:is_ - 1] || o[im + 3:len] || o[is_ + 3:im - 1]
                   ELSE o[ip + 3:im - 1] || o[im + 3:len] || o[is_ + 3:ip - 1] END) AS restored_sha256
FROM w
"""
#: The trees level by level from below, then every leaf's siblings, then the fold along them.
OP12_SQL = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS seen, n_chars,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS a,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS z
  FROM (SELECT *, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc FROM documents)),
l AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256(a || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf,
    sha256(a || coalesce(strlen(CAST(seen AS VARCHAR)) || ':' || seen, '-') || z) AS seen FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM l),
t(k, tree, i, n, h) AS (
  SELECT 0, tree, i, n, leaf FROM p
  UNION ALL
  SELECT k + 1, tree, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY k, tree, i // 2, (n + 1) // 2),
s AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(k, i, n, h) AS (
  SELECT 0, i, n, h FROM s
  UNION ALL
  SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY k, i // 2, (n + 1) // 2),
steps AS (
  SELECT p.tree, p.i, 0 AS part, t.k, coalesce(CASE WHEN t.i % 2 = 0 THEN 'R' ELSE 'L' END || b.h, '-') AS step
  FROM p JOIN t ON t.tree = p.tree AND t.i = p.i >> t.k AND t.n > 1
  LEFT JOIN t b ON b.tree = t.tree AND b.k = t.k AND b.i = xor(t.i, 1)
  UNION ALL
  SELECT p.tree, p.i, 1, u.k, coalesce(CASE WHEN u.i % 2 = 0 THEN 'R' ELSE 'L' END || b.h, '-')
  FROM p JOIN s ON s.tree = p.tree JOIN u ON u.i = s.i >> u.k AND u.n > 1 LEFT JOIN u b ON b.k = u.k AND b.i = xor(u.i, 1)),
proofs AS (SELECT tree, i, list(step ORDER BY part, k) AS steps FROM steps GROUP BY tree, i),
r AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(q.steps, []) AS steps, p.seen
  FROM p JOIN s ON s.tree = p.tree LEFT JOIN proofs q ON q.tree = p.tree AND q.i = p.i),
o AS (
  SELECT *, list_reduce(list_prepend(seen, steps), lambda h, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || h) WHEN 'R' THEN sha256(h || x[2:])
    ELSE sha256(h) END) AS folded_root FROM r)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(list_filter(steps, lambda x: x <> '-'), lambda x: x[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM o
"""
ORACLE: dict[str, str] = {"op1_ngram_jaccard_join": OP1_SQL, "op11_fill_in_middle": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
