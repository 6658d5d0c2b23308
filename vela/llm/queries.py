"""One registered query per operator (``opN_<name>``) and its DuckDB SQL where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vela.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.decontaminate import contaminated, decontaminate
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", contaminated().alias("contaminated"))


#: Lower-cased words of a text, as a list (bytes A-Z only are folded).
_WORDS = "regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), 13) AS m,
               array_to_string(list_slice(w, s::BIGINT, (s + least(len(w), 13) - 1)::BIGINT), ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, s, array_to_string(list_slice(w, s::BIGINT, (s + m - 1)::BIGINT), ' ') AS t
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT dw.doc_id, dw.s, dw.m, win.item FROM dw JOIN win ON dw.t = win.t AND dw.m = win.m),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w)) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.common import crc_mod
    from vela.llm.langid import fit_langid, identify, train_rows
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, fit_langid(train_rows(docs)))
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.ngram_join import ngram_join
    return ngram_join(read(spark, sf_dir, "documents"))


ORACLES["op10_ngram_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s::BIGINT, (s + least(len(w), 5) - 1)::BIGINT), ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b, c, x.n AS na, y.n AS nb FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
cls AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
deg AS (SELECT a AS doc_id, count(*) AS n_links, count(*) FILTER (c = na AND na = nb) AS same FROM link GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, (coalesce(same, 0) + 1)::BIGINT AS copies, coalesce(n.n, 0)::BIGINT AS n_shingles
FROM d JOIN cls USING (doc_id) LEFT JOIN deg USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from vela.llm.packing import best_fit_pack
    return best_fit_pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.suffix_tree_dedup import dedup_substrings
    found = dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op7_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(list_slice(w, s::BIGINT, (s + 19)::BIGINT), ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM late),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.bwt_dedup import dedup_bytes
    found = dedup_bytes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.winnow import fingerprint_and_edit, spelled
    found = fingerprint_and_edit(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), spelled("fingerprint").alias("fingerprint"),
                        spelled("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.html_extract import extract
    found = extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.common import crc_mod
    from vela.llm.quality import score_quality
    labels = read(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    found = score_quality(read(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from vela.llm.token_counts import count_tokens
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.tree_dedup import exact_dedup
    found = exact_dedup(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op11_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", label), "id % 100 = 0")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLES["op12_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vela.llm.resample import importance_resample
    found = importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: CRC-32 byte by byte, over a table made of the reversed polynomial.
ORACLES["op13_importance_resampling"] = f"""
WITH RECURSIVE bits AS (SELECT range AS byte, range AS v, 0 AS step FROM range(256)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE step = 8),
docs AS (SELECT row_number() OVER () AS r, doc_id, 'd' AS kind, {_WORDS.format('text')} AS w FROM documents
         UNION ALL SELECT row_number() OVER (), NULL, 'b', {_WORDS.format('text')} FROM benchmark),
grams AS (SELECT kind, r, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
          FROM (SELECT kind, r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)),
counted AS (SELECT kind, r, g, count(*) AS c FROM grams GROUP BY ALL),
named AS (SELECT g, xor(list_reduce(list_transform(range(1, octet_length(encode(g)) * 2, 2), lambda i: ('0x' || substr(hex(encode(g)), i, 2))::BIGINT),
                                lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
          FROM (SELECT DISTINCT g FROM counted), crc),
feats AS (SELECT kind, r, bucket, sum(c)::BIGINT AS c FROM counted JOIN named USING (g) GROUP BY ALL),
tot AS (SELECT coalesce(sum(c) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (kind = 'b'), 0)::DOUBLE AS t FROM feats),
per AS (SELECT bucket, coalesce(sum(c) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (kind = 'b'), 0)::DOUBLE AS t FROM feats GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((per.t + 1) * (tot.s + 10000) / ((per.s + 1) * (tot.t + 10000))))::BIGINT AS gain FROM per, tot),
weighed AS (SELECT r, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM feats JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY r),
scored AS (SELECT doc_id, len(w) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM docs LEFT JOIN weighed USING (r) WHERE kind = 'd'),
placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, 5 * count(*) OVER (PARTITION BY able) // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= drawn THEN place END::BIGINT AS rank FROM placed
"""
