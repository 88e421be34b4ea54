"""The thirteen operators over the test tables, with the settings they are meant to run with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storepulse.llm import (
    bpe, chat, exact_dedup, jaccard_join, language_id, lattice_lm, license_scan, orchard, packing, pii, simple8b,
    topk, whitening)
from storepulse.llm.tables import fold, read


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


ESCAPED = r"\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ESCAPED).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_conversations(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    back = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"),
                       chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    lines = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 3) == 1
    model = language_id.train(docs.filter(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"), digest_all=True)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), width=3, percent=90)


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = simple8b.write_token_files(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return simple8b.digest(simple8b.read_token_files(spark, path))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = lattice_lm.score_documents(
        docs, public_tokenizers.path("piece_bpe_32k.model"), train=fold("doc_id", 10) != 0)
    return found.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings"), components=8, scale=1024.0, shift=100_000)
    return found.select("vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                        "whitened", "explained", "identity_error")


def op12_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


def op13_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(read(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, scale=64.0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {q.__name__: q for q in (
    op1_topk, op2_chat, op3_language, op4_exact_dedup, op5_jaccard, op6_token_ids, op7_lm_score, op8_pii,
    op9_packing, op10_bpe, op11_whitening, op12_license, op13_orchard, pipeline)}

def _clusters_sql(k: int, rounds: int, size: int, scale: int) -> str:
    """k-means by comparing every vector with every centroid."""
    far = "CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.x, c.x)]) AS BIGINT)"
    near = lambda c: f"""SELECT v.r, v.vec_id, v.x, min(struct_pack(d := {far}, c := c.c)) AS best
          FROM v CROSS JOIN {c} c GROUP BY v.r, v.vec_id, v.x"""  # noqa: E731
    moves = ", ".join(f"""
        a{i} AS MATERIALIZED ({near(f'c{i}')}),
        m{i} AS (SELECT c, list(m ORDER BY d) AS x FROM (
                   SELECT best.c AS c, d, CAST(floor(sum(x[d]) / count(*)) AS BIGINT) AS m
                   FROM a{i}, range(1, {size + 1}) t(d) GROUP BY best.c, d) GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)"""
                      for i in range(rounds))
    return f"""WITH v AS MATERIALIZED (
          SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
          FROM embeddings WHERE len(embedding) = {size} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
          FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v) ORDER BY h, x LIMIT {k}), {moves},
        f AS MATERIALIZED ({near(f'c{rounds}')}),
        s AS (SELECT best.c AS c, sum(best.d) AS s FROM f GROUP BY best.c)
        SELECT f.vec_id, CAST(f.best.c AS INT) AS cluster, f.best.d AS distance, CAST(s.s AS BIGINT) AS cluster_inertia,
               CAST((SELECT sum(best.d) FROM f) AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM f JOIN s ON s.c = f.best.c JOIN c{rounds} c ON c.c = f.best.c"""


def _licenses_sql() -> str:
    """The same votes by joining words with words; spans as the operator defines them."""
    templates = ", ".join(
        f"({i}, {t.words.split(' ')}, '{t.label}', {t.base}, {t.least}, {t.drift}, {t.k})"
        for i, t in enumerate(license_scan.default_templates()))
    places = lambda rows, last: f"unnest(range(0, greatest(len({rows}) - {last} + 1, 0)))"
    covered = lambda mask: f"""bit_count({mask} | ({mask} << 1) | CASE WHEN k = 4 THEN ({mask} << 2) | ({mask} << 3) ELSE 0 END)
                               / len(t.words)"""  # noqa: E731
    return f"""WITH t(template, words, label, base, least, drift, k) AS (VALUES {templates}),
        w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '{license_scan.BETWEEN}'), lambda x: x <> '') AS words FROM documents),
        dg AS (SELECT r, i, words[i + 1] AS w0, words[i + 2] AS w1, words[i + 3] AS w2, words[i + 4] AS w3
               FROM (SELECT r, words, {places('words', 2)} AS i FROM w)),
        tg AS (SELECT template, k, o, words[o + 1] AS w0, words[o + 2] AS w1, words[o + 3] AS w2, words[o + 4] AS w3
               FROM (SELECT template, k, words, {places('words', 'k')} AS o FROM t)),
        vote AS (SELECT r, template, i - o AS diagonal, bit_or(1::BIGINT << o) AS mask, min(i) AS a, max(i + k - 1) AS b
                 FROM dg JOIN tg ON dg.w0 = tg.w0 AND dg.w1 = tg.w1 AND (k = 2 OR (dg.w2 = tg.w2 AND dg.w3 = tg.w3))
                 GROUP BY ALL),
        step AS (SELECT vote.*, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= drift
                                     THEN 0 ELSE 1 END AS fresh FROM vote JOIN t USING (template)),
        run AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM step),
        span AS (SELECT r, template, label, base, least, max(b) - min(a) + 1 AS wide,
                        {covered('bit_or(mask)')} AS together,
                        max(struct_pack(cover := {covered('mask')}, back := -a)) AS alone, min(a) AS a, t.words AS tw
                 FROM run JOIN t USING (template) GROUP BY r, template, run, label, base, least, k, t.words),
        hit AS (SELECT r, label, base, CASE WHEN whole THEN a ELSE -alone.back END AS a,
                       CASE WHEN whole THEN together ELSE alone.cover END AS cover
                FROM (SELECT *, wide <= 1.5 * len(tw) AND together >= alone.cover AS whole FROM span)
                WHERE CASE WHEN whole THEN together ELSE alone.cover END >= least),
        told AS (SELECT r, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word,
                        max(a) FILTER (base) AS last_word,
                        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM hit GROUP BY r)
        SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM w LEFT JOIN told USING (r)"""


_SQUEEZED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
_ESCAPE = r"replace(replace(replace({0}, '\', '\b'), '<', '\l'), '>', '\g')"

ORACLE_SQL = {
    "op1_topk": """
        WITH q AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
                   FROM embeddings WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
              FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
                     vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_chat": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{ESCAPED}' UNION ALL SELECT -7, 1, 'assistant', '{ESCAPED}'),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                            FILTER (WHERE role = 'assistant'), '') AS learned,
                   CAST(sum(16 + length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')})) AS BIGINT)
                       AS formatted_chars
            FROM t GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
               sha256(learned) AS loss_sha256, formatted_chars FROM g""",
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256({_SQUEEZED}) AS text_sha256 FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS place,
                     first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r""",
    "op5_jaccard": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x20\x09-\x0D]+') AS words FROM documents),
        e AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ')
                  ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS shingle
              FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS i
                    FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
        links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
                  WHERE least(x.n, y.n) * 100 >= 90 * greatest(x.n, y.n)
                  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id FROM documents d
        LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id""",
    "op12_license": _licenses_sql(),
    "op13_orchard": _clusters_sql(k=16, rounds=3, size=64, scale=64),
}
