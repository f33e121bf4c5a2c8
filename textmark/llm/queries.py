"""The numbered queries over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.llm import decontaminate, jaccard, language, lattice, lm, negatives, packing, pii, prefix_trie, quality, secret_scan, spiece, warc
from textmark.llm.frames import stored
from textmark.llm.labelled import fold

Query = Callable[[SparkSession, str], DataFrame]

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lattice_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


OP1_SQL = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v,
         embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid
  FROM embeddings
),
links AS (
  SELECT x.r AS a, y.r AS b FROM vectors x JOIN vectors y
    ON x.r <> y.r AND x.valid AND y.valid AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
),
reach AS (
  SELECT r AS a, r AS b FROM vectors
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS r, min(v.vec_id) AS component_id FROM reach JOIN vectors v ON v.r = reach.b GROUP BY a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least USING (r) LEFT JOIN counted USING (r)
"""


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of documents and where each stands, with the checksum of their ids."""
    import public_tokenizers

    pieces = packing.tokenized(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "split", "nth")
    return packing.placed(pieces)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


_SPACED = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
OP3_SQL = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {_SPACED} AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s)
  WHERE x.r <> y.r GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach AS (
  SELECT r AS a, r AS b FROM docs
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (r) JOIN least USING (r)
"""


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.new_folder(spark)
    index = warc.write(table(spark, folder, "pages"), archives)
    return warc.read(index, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(((('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '')"""
OP4_SQL = f"""
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT html, min(page_id) AS f FROM pages_ GROUP BY html HAVING count(*) > 1),
marked AS (SELECT p.*, f, f IS NOT NULL AND page_id IS DISTINCT FROM f AS again FROM pages_ p LEFT JOIN firsts USING (html))
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN f END AS refers_to
FROM marked
"""


def op5_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    out = lm.scores(table(spark, folder, "documents"), fold("doc_id", 10) != 0)
    held_out = (fold("doc_id", 10) == 0).alias("held_out")
    return out.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "benchmark"))
    rows = table(spark, folder, "documents").select("doc_id", found(F.col("text")).alias("r"))
    return rows.select(
        "doc_id",
        "r.n_words",
        "r.n_hit",
        F.size("r.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("r.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("r")).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
marked AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
),
named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", pii.find(F.col("text")).alias("s"))
    return rows.select(
        "doc_id",
        *[pii.count(F.col("s"), kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(F.col("s"), pii.BASE), 256).alias("base_sha256"),
        pii.joined(F.col("s")).alias("spans"),
    )


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.described(secret_scan.findings(table(spark, folder, "documents")))
    found = stored(found, "secrets-findings")  # texts are read once, for training and scoring
    labelled = found.where(fold("key", 4) != 2).withColumn("label", secret_scan.weak_label())
    scored = secret_scan.scored(found, secret_scan.train(labelled), "doc_id")
    return scored.select(
        "doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"),
        "probability", "is_secret",
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    predict = language.predictor(language.fit(docs.where(fold("doc_id", 4) != 2)))
    rows = docs.select("doc_id", predict("text").alias("r"))
    return rows.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.col("r.language").alias("lang_pred"),
        "r.score",
    )


def quality_model(spark: SparkSession, folder: str) -> quality.Model:
    """Trained on the labels whose fold is not held out."""
    labels = table(spark, folder, "labels").where(fold("doc_id", 4) != 2)
    return quality.fit(table(spark, folder, "documents"), labels)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    score = quality.scorer(quality_model(spark, folder))
    rows = table(spark, folder, "documents").select("doc_id", score("text").alias("score"))
    return rows.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        quality.accepted(F.col("score")).cast("int").alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    base = F.col("conv") - F.col("conv") % 100
    taken = F.crc32(F.col("conv").cast("string")) % 6
    turns = prefix_trie.turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns, base, taken))


# DuckDB has no crc32: one bit at a time over the digits.
_CRC32 = """list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
  lambda crc, d: list_reduce(list_prepend(xor(crc, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(coalesce(role, ''), 32),
           left(coalesce(text, ''), 32), md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor({_CRC32}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.pos, 0 AS own, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, 1, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
),
listed AS (
  SELECT c.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY own, pos) FILTER (WHERE pos IS NOT NULL), []) AS x
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id
),
keyed AS (
  SELECT conv_id, x, list_transform(range(0, len(x) + 1),
    lambda d: sha256(CAST(d AS VARCHAR) || CAST(list_transform(list_slice(x, 1, d), lambda t: md5(len(t.role) || ':' || t.role || t.text)) AS VARCHAR))) AS keys
  FROM listed
),
members AS (SELECT conv_id, x, keys, unnest(range(0, len(x) + 1)) AS depth FROM keyed),
nodes AS (
  SELECT keys[depth + 1] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(x) = depth) AS ends
  FROM members GROUP BY 1, 2
),
placed AS (
  SELECT n.*, k.keys, CASE WHEN n.depth > 0 THEN k.keys[n.depth] END AS parent,
         CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * len(k.x[n.depth].text) ELSE 0 END AS own
  FROM nodes n JOIN keyed k USING (conv_id)
),
children AS (SELECT parent AS key, count(*) AS n_children FROM placed WHERE parent IS NOT NULL GROUP BY 1),
full_ AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM placed p LEFT JOIN children USING (key)),
below AS (
  SELECT key, sum(leaf) AS n_leaves, sum(own) AS saved_tokens
  FROM (SELECT unnest(list_slice(keys, 1, depth + 1)) AS key, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, own FROM full_)
  GROUP BY 1
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM full_ f JOIN below b USING (key) LEFT JOIN full_ up ON up.key = f.parent
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, folder, "embeddings"), label, F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS r, b.vec_id AS vec_id,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS INT) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = spiece.encoded(table(spark, folder, "documents"), path).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )
    rows = spiece.decoded(rows, path, ["doc_id", "n_tokens", "ids_sha256", "spans_sha256"])
    return rows.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"), "spans_sha256"
    )


QUERIES: dict[str, Query] = {
    "op1_lattice_near_duplicates": op1_lattice_near_duplicates,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_warc": op4_warc,
    "op5_lm_scores": op5_lm_scores,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_secrets": op8_secrets,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sentencepiece": op13_sentencepiece,
}

SQL: dict[str, str] = {
    "op1_lattice_near_duplicates": OP1_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op6_decontamination": OP6_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
