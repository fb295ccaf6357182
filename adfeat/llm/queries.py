"""Named queries over the driver's tables, one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.llm.common import read_table
from adfeat.llm.embedding_dedup import near_vectors
from adfeat.llm.language import identify
from adfeat.llm.line_dedup import dedup_lines
from adfeat.llm.merkle import build_manifest, fold, leaf_digest, proof_digest, prove
from adfeat.llm.mixing import DOMAINS, mix
from adfeat.llm.near_dup import near_duplicates
from adfeat.llm.packing import pack_documents
from adfeat.llm.page_text import extract_main
from adfeat.llm.periodic import periodic_runs, planted, run_digests
from adfeat.llm.pii import personal_data
from adfeat.llm.quality import quality_rules, trusted_rows
from adfeat.llm.repeats import remove_repeats
from adfeat.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return quality_rules(read_table(spark, sf_dir, "documents"), trusted_rows(labels.where("toxic = 0")), labels=labels)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)


def op5_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=5, threshold=75)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"), size=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    posteriors = [F.col("posterior")[i].alias(f"p_{d.name}") for i, d in enumerate(DOMAINS)]
    return out.select("doc_id", "n_words", *posteriors, "rate", "copies")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    return run_digests(periodic_runs(docs, min_length=24, min_exponent=3))


#: What a leaf of op13 is made of, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    changed = leaf_digest(*(F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in LEAF))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, changed).otherwise(leaf_digest(*(F.col(c) for c in LEAF)))
    manifest = build_manifest(docs, LEAF, carry={"doc_id": F.col("doc_id"), "brought": tampered})
    root = F.lit(manifest.root)
    out = prove(manifest).select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.col("brought"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == root)


def registry() -> dict[str, Query]:
    own = (op1_quality_rules, op2_line_dedup, op3_token_counts, op4_best_fit_packing, op5_skip_chain_pii, op6_minhash_forest, op7_suffix_array, op8_spherical_caps, op9_mixing, op10_language_id, op11_page_text, op12_periodic_runs, op13_merkle_manifest)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


#: Lines of every text with their keys; chr(9) to chr(13) and the space are stripped, A-Z lower-cased.
_LINES = """
lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
)"""

_OP2 = f"""
WITH {_LINES},
keys AS (SELECT k, max(doc_id) AS largest FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.doc_id, l.pos, l.line, coalesce(s.largest <> l.doc_id, false) AS dropped FROM lines l LEFT JOIN keys s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: Brute force: common shingles of all pairs, then everything that links reach.
_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
                               ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS s
    FROM w)
),
n AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT arcs.b, reach.r FROM reach JOIN arcs ON arcs.a = reach.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""

#: Brute force: every 100-byte string (as hex), all but the first of which are removed.
_OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS s FROM d),
strings AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS k FROM starts),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM strings) WHERE r > 1),
runs AS (
  SELECT doc_id, min(s) AS s, max(s) + 100 AS e FROM (
    SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (
      SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY doc_id, run
),
edges AS (SELECT doc_id, s, e FROM runs UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM d),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS after FROM edges),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * after + 1, 2 * (s - after)), '' ORDER BY s, e) AS h,
         sum(e - s) AS n_removed, count(*) - 1 AS n_spans
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""

#: Brute force: the cosine of all pairs.
_OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) LEFT JOIN n USING (vec_id)
"""


#: crc32 of the decimal id, bit by bit (unsigned).
_CRC = """xor(list_reduce([4294967295::UBIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0])),
  lambda c, v: xor(xor(c, v) >> 1, (xor(c, v) & 1) * 3988292384)), 4294967295)"""


def _leaf(text: str) -> str:
    parts = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END" for c, v in zip(LEAF, [*LEAF[:-1], text], strict=True))
    return f"sha256({' || '.join(parts)})"


#: All levels of all trees, the siblings of every leaf on every level, and the fold from the brought leaf up.
_OP13 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS brought, source
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size,
         row_number() OVER () AS id
  FROM d
),
nodes(tree, lev, place, size, digest) AS (
  SELECT tree, 0, place, size, leaf FROM leaves
  UNION ALL
  SELECT tree, lev + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM nodes WHERE size > 1 GROUP BY tree, lev, place // 3, size
),
subroots AS (SELECT tree, lev AS height, digest, count(*) OVER () AS size FROM nodes WHERE size = 1),
tops(lev, place, size, digest) AS (
  SELECT 0, tree, size, digest FROM subroots
  UNION ALL
  SELECT lev + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM tops WHERE size > 1 GROUP BY lev, place // 3, size
),
ups AS (SELECT unnest(range(0, 40)) AS up),
steps AS (
  SELECT id, up AS lev, n.place AS pos, n.digest, n.place < l.place // pow(3, up)::BIGINT AS before
  FROM leaves l JOIN subroots s USING (tree) JOIN ups ON up < s.height
  LEFT JOIN nodes n ON n.tree = l.tree AND n.lev = up AND n.place // 3 = l.place // pow(3, up + 1)::BIGINT AND n.place <> l.place // pow(3, up)::BIGINT
  UNION ALL
  SELECT id, s.height + up, n.place, n.digest, n.place < l.tree // pow(3, up)::BIGINT
  FROM leaves l JOIN subroots s USING (tree) JOIN ups ON up < (SELECT max(lev) FROM tops)
  LEFT JOIN tops n ON n.lev = up AND n.place // 3 = l.tree // pow(3, up + 1)::BIGINT AND n.place <> l.tree // pow(3, up)::BIGINT
),
paths AS (
  SELECT id, lev, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE before), '') AS l, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (WHERE NOT before), '') AS r
  FROM steps GROUP BY id, lev
),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY lev)) AS proof_sha256 FROM paths GROUP BY id),
folds(id, lev, digest) AS (
  SELECT id, 0, brought FROM leaves
  UNION ALL
  SELECT f.id, f.lev + 1, sha256(p.l || f.digest || p.r) FROM folds f JOIN paths p ON p.id = f.id AND p.lev = f.lev
),
folded AS (SELECT id, arg_max(digest, lev) AS folded_root FROM folds GROUP BY id),
root AS (SELECT digest AS root FROM tops WHERE size = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots s USING (tree) JOIN folded USING (id) LEFT JOIN proofs USING (id), root
"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; the others are tested against brute force."""
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"op2_line_dedup": _OP2, "op6_minhash_forest": _OP6, "op7_suffix_array": _OP7, "op8_spherical_caps": _OP8, "op13_merkle_manifest": _OP13} | pipeline
