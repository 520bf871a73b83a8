"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import langid, quality
from playlens.llm.common import held_out, table
from playlens.llm.decontaminate import decontaminate
from playlens.llm.linededup import dedup_lines
from playlens.llm.mtree import top_k
from playlens.llm.packing import pack_documents
from playlens.llm.resample import resample
from playlens.llm.setjoin import Rule, similar_documents
from playlens.llm.sharding import balanced_shards
from playlens.llm.simhash import near_duplicates
from playlens.llm.spelling import spelling_variants
from playlens.llm.substrings import remove_repeats
from playlens.llm.tokens import default_tokenizer
from playlens.llm.trainorder import write_training_order

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    forest = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, forest, threshold=0.3)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@register
def op2_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


SQL["op2_top_k_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pair QUALIFY rank <= 10
"""


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), default_tokenizer(), window=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts are linked by a 64-bit hash: a collision would only put two texts together."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    sized = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("same_text"),
    )
    dealt = balanced_shards(sized, F.col("same_text"), shards=16)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@register
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), max_bits=3, shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_training_order(documents(spark, sf_dir), default_tokenizer(), key=20240101)
    return written.drop("path")


@register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = langid.identify_languages(docs.select("doc_id", "text"), langid.train(docs))
    return judged.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op8_substring_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
place AS (SELECT doc_id, n, h, unnest(range(n)) AS i FROM d),
named AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN i + 100 <= n THEN md5(substr(h, 2 * i + 1, 200)) END AS k
  FROM place),
late AS (
  SELECT doc_id, i, byte,
         k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS is_late FROM named),
covered AS (
  SELECT doc_id, i, byte, max(CASE WHEN is_late THEN i END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM late),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM covered),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM edges GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)
"""


@register
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(documents(spark, sf_dir), min_docs=5, min_chars=40, by_number=True)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


SQL["op9_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM line),
heavy AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, heavy.keeper IS NOT NULL AND heavy.keeper <> doc_id AS dropped
  FROM keyed LEFT JOIN heavy USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    judged = decontaminate(documents(spark, sf_dir), benchmark, window=13, share=20)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    counts = ("n_words", "n_hit", F.size("items").cast("long").alias("n_items"))
    return judged.select("doc_id", *counts, digest.alias("items_sha256"), "contaminated")


SQL["op10_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS t FROM (
    SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
    FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS t FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
    FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hit AS (SELECT doc_id, size, p, item_id FROM place JOIN win USING (size, t)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "benchmark").select("text")
    return resample(documents(spark, sf_dir), target, low=1, high=1, buckets=10_000, percent=10, min_words=20)


# CRC-32 of the column ``x``, a byte at a time by the usual table of 256 steps.
CRC_TABLE = """
crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""
CRC_OF_X = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, length(hex(encode(x))) // 2), lambda i: ('0x' || substr(hex(encode(x)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"""

SQL["op11_importance_resampling"] = (
    f"""
WITH {CRC_TABLE},
text AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark),
doc AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM text),
word AS (SELECT side, doc_id, x, count(*) AS n FROM (SELECT side, doc_id, unnest(w) AS x FROM doc) GROUP BY ALL),
known AS (SELECT x, {CRC_OF_X} % 10000 AS bucket FROM (SELECT DISTINCT x FROM word), crc_table),
sums AS (
  SELECT bucket, sum(n) FILTER (WHERE side = 'd') AS s, sum(n) FILTER (WHERE side = 't') AS t
  FROM word JOIN known USING (x) GROUP BY bucket),
whole AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM sums),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000)
         / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS g FROM sums, whole),
weight AS (
  SELECT doc_id, sum(n * g)::BIGINT AS weight FROM word JOIN known USING (x) JOIN gain USING (bucket)
  WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT) + 0.5::DOUBLE)
         / 4294967296::DOUBLE)))::BIGINT AS score
  FROM doc LEFT JOIN weight USING (doc_id) WHERE side = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS many FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= many * 10 // 100 THEN place END AS rank
FROM ranked
"""
)


@register
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), min_length=7, min_count=2, ratio=10, every=31)


SQL["op12_spelling_variants"] = (
    f"""
WITH RECURSIVE {CRC_TABLE},
run AS (
  SELECT doc_id, r, count(*) AS n, doc_id || ':' || r AS x FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY ALL),
hashed AS (SELECT r, n, {CRC_OF_X} AS h FROM run, crc_table),
result AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INTEGER) || substr(r, (h % length(r))::INTEGER + 2)
         ELSE r END AS word, n FROM hashed),
word AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM result WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS best FROM pair GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN best END AS form,
         CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM word LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, formed.form, steps + 1 FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL),
last AS (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""
)


@register
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_documents(documents(spark, sf_dir), Rule(shingle=4, num=85, den=100))
    # A document without words is linked with nothing.
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", alone.alias("component_id"))


SQL["op13_jaccard_join"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS p FROM doc WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * shared.n >= 85 * (a.n + b.n - shared.n)),
edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x, y FROM edge UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y),
least AS (SELECT x, min(y) AS low FROM reach GROUP BY x)
SELECT doc.doc_id, coalesce(size.n, 0) AS n_shingles, least(doc.doc_id, coalesce(low, doc.doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least ON least.x = doc.doc_id
"""
