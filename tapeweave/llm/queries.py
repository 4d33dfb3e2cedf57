"""The numbered queries over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bestposition, bytebpe, collocations, jaccard, licenses, line_dedup, mixing, neighbours, packing, quality, secrets, substrings, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), shingle=4, num=85, den=100)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=1000)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality.quality_rules(table(spark, sf_dir, "documents"), trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), query_every=50, k=5)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, cover=50, top=2000)


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ranks_path()
    tokens = bytebpe.decode(bytebpe.encode(table(spark, sf_dir, "documents"), path), path)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_best_fit_packing, op3_license_scan, op4_line_dedup, op5_warc, op6_secret_scan, op7_mixing, op8_quality_rules, op9_nearest, op10_substring_dedup, op11_collocations, op12_best_position, op13_byte_bpe)}

ORACLES = {
    "op4_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT d.*, c.k IS NOT NULL AND d.doc_id <> c.keeper AS gone FROM keyed d LEFT JOIN common c ON d.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to FROM m""",
    "op7_mixing": r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sized GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
ordered AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
                   sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
            FROM caps WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
turns AS (SELECT *, (total - caps_before) * w / w_left <= cap AS fits FROM ordered),
first AS (SELECT total - caps_before AS rest, w_left AS left_w, cap / w AS ratio, source AS at FROM turns WHERE fits ORDER BY cap / w, source NULLS LAST LIMIT 1),
targets AS (SELECT s.source, s.source_size, CASE WHEN s.cap / s.w > f.ratio OR (s.cap / s.w = f.ratio AND (s.source IS NOT DISTINCT FROM f.at OR s.source > f.at OR s.source IS NULL)) THEN f.rest * s.w / f.left_w ELSE s.cap END AS target
            FROM caps s LEFT JOIN first f ON TRUE),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, coalesce(doc_id % 4096, 4096), doc_id NULLS LAST) AS k FROM sized),
steps AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.k, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                 ('0x' || substr(md5('mix:' || coalesce(r.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift
          FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * least(floor(rate * k + shift) - floor(rate * (k - 1) + shift), 2)::BIGINT AS taken FROM steps""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM split),
f1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM placed GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM placed WHERE i + 1 <= len(w) GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM placed WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
most AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
two AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, x.f AS l, y.f AS r, ((1000000::HUGEINT * f2.f * f2.f) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.p = f2.a JOIN f1 y ON y.lang = f2.lang AND y.p = f2.b LEFT JOIN most m ON m.lang = f2.lang AND m.a = f2.a AND m.b = f2.b
  WHERE f2.f >= 10 AND (m.f IS NULL OR 100 * m.f < 50 * f2.f)),
cuts AS (
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
         ((1000000::HUGEINT * f3.f * f3.f) // (x.f::HUGEINT * yz.f))::BIGINT AS s1, ((1000000::HUGEINT * f3.f * f3.f) // (xy.f::HUGEINT * z.f))::BIGINT AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.p = f3.a JOIN f1 z ON z.lang = f3.lang AND z.p = f3.c
  JOIN f2 xy ON xy.lang = f3.lang AND xy.a = f3.a AND xy.b = f3.b JOIN f2 yz ON yz.lang = f3.lang AND yz.a = f3.b AND yz.b = f3.c),
found AS (
  SELECT * FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM found)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_best_position": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT docs FROM whole) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM sizes, whole),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
}
