"""The operators over whole tables with production parameters."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.llm import audit, decontaminate, langid, lines, lm, minhash, packing, phrases, quality, repeats, token_counts, token_files, vectors
from isoloom.llm.common import documents, shared_dir


def tokenizer(name: str) -> str:
    """Path of a vocabulary file. TOKENIZERS_DIR names another folder of them."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def share(doc_id: Column, of: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves the rest."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == rest, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, u.i AS pos, u.line,
         translate(trim(u.line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS i) u),
c AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, c.keeper IS NOT NULL AND l.doc_id < c.keeper AS gone FROM l LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    slim = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.cut_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", share(F.col("doc_id"), 5, 1))
    model = lm.train(docs.where("not held_out"))
    out = lm.score(docs.select("doc_id", "held_out", "text"), model, last=True)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", share(F.col("doc_id"), 4, 2))
    model = langid.train(docs.where("not held_out"))
    out = docs.select("doc_id", "held_out", langid.predict(F.col("text"), model).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", F.array_join("p.langs", ",").alias("langs"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(token_files.encode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=2, stored=True), path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(documents(spark, sf_dir), into="q")
    return out.select("doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], (F.col("q.verdict") == "keep").alias("kept"), "q.verdict", "q.ratio")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
u AS (SELECT lang, unnest(ws) AS w1, unnest(list_append(ws[2:], NULL)) AS w2, unnest(ws[3:] || [NULL, NULL]) AS w3, unnest(ws[4:] || [NULL, NULL, NULL]) AS w4 FROM w WHERE len(ws) > 0),
g AS (SELECT lang, unnest([w1, w1 || ' ' || w2, w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4]) AS ph, unnest([1, 2, 3, 4]) AS size FROM u),
f AS MATERIALIZED (SELECT lang, ph, size, count(*) AS f FROM g WHERE ph IS NOT NULL GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f)::bigint AS n FROM f WHERE size = 1 GROUP BY 1),
c AS MATERIALIZED (SELECT lang, ph, size, string_split(ph, ' ') AS ws, f AS a FROM f WHERE size > 1 AND f >= 30),
y AS (SELECT lang, ph, a, k, array_to_string(ws[1:k], ' ') AS p, array_to_string(ws[k + 1:], ' ') AS q FROM c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
x AS (
  SELECT y.lang, y.ph, y.a, l.f AS l, r.f AS r, (2000000::hugeint * y.a // (l.f + r.f))::bigint AS score, k
  FROM y JOIN f l ON l.lang = y.lang AND l.ph = y.p JOIN f r ON r.lang = y.lang AND r.ph = y.q),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
s AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS ph, max(a) AS longer
  FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < size AND i + m - 1 <= size GROUP BY 1, 2),
k AS (SELECT b.*, b.ph AS phrase FROM b LEFT JOIN s USING (lang, ph) WHERE longer IS NULL OR 100::hugeint * longer < 80::hugeint * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM k JOIN n USING (lang) QUALIFY rank <= 2000
"""


def op12_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::double[] AS e, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) AS norm FROM embeddings),
g AS (SELECT vec_id, label, list_transform(e, lambda x: x / norm) AS u FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND norm > 0 AND isfinite(norm)),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_dot_product(a.u, b.u) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a WHERE r.c < l.b),
c AS (SELECT a AS vec_id, min(c) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS lead FROM d),
f AS (
  SELECT doc_id, part,
         [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(lead < doc_id, false)] AS fs
  FROM w),
g AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, fs, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN g USING (doc_id) GROUP BY 1, 2),
l AS (SELECT unnest(generate_series(1, 5)) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS os FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (
  SELECT part, list_aggregate(list_transform(os, lambda x: chr(64 + x::int)), 'string_agg', '') AS filter_order, step::int AS step, os[step] AS own, n, good, toxic,
         fs[os[step]] AS fails, list_bool_or(list_transform(os[1:step - 1], lambda x: fs[x])) IS TRUE AS gone,
         fs[os[step]] AND len(list_filter(fs, lambda x: x)) = 1 AS alone
  FROM c, o, (SELECT unnest(generate_series(1, 5)) AS step)),
r AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::bigint AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::bigint AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::bigint AS redundant, coalesce(sum(n) FILTER (WHERE alone), 0)::bigint AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0)::bigint AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0)::bigint AS toxic_lost
  FROM s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::bigint AS shapley
FROM r
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_packing, op3_token_counts, op4_minhash, op5_repeats, op6_lm_scores, op7_decontamination, op8_langid, op9_token_files, op10_quality, op11_collocations, op12_embedding_links, op13_filter_audit, pipeline)}
SQL = {"op1_line_dedup": OP1_SQL, "op11_collocations": OP11_SQL, "op12_embedding_links": OP12_SQL, "op13_filter_audit": OP13_SQL}
