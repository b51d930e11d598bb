"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm import (bpe, brown, conversations, filter_audit, order_minhash, quality, sharding, substrings,
                           suffixes, templates, token_files, toxicity, vectors)
from roadpulse.session import fresh_dir

QUERIES = {}
SQL: dict[str, str] = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The public vocabulary file, found where each process has it installed."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@registered
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(remainder(3) != 1), "toxic")
    held = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs.select("doc_id", "text"), model) \
        .select("doc_id", held, "score", "predicted")


@registered
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(remainder(3) != 1), "quality")
    held = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return quality.score(docs.select("doc_id", "text"), model) \
        .select("doc_id", held, "score", "predicted")


@registered
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.near_duplicates(docs).select("doc_id", "class_id", "n_copies", "kept")


@registered
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write(docs, vocabulary_path(), fresh_dir(spark, "tokens"))
    rows = token_files.starts(token_files.checksums(files), files)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@registered
def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = brown.score(docs, remainder(7) != 2)
    held = F.coalesce(remainder(7) == 2, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@registered
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@registered
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary_path(), keep_ids=False) \
        .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@registered
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@registered
def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))         .select("vec_id", "n_links", "component_id", "kept")


@registered
def op10_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "n_tokens", "n_changed")


@registered
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_stored(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@registered
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damage(table(spark, sf_dir, "conversations")))


@registered
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op7_vectors"] = """
    WITH RECURSIVE good AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
        ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
      WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
    reach(a, b) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, e.vec_id = c AS kept
    FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id"""


SQL["op6_substrings"] = r"""
    WITH d AS (
      SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                 lambda x: x <> '') AS words FROM documents),
    starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS k FROM starts),
    twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i
             FROM windows SEMI JOIN twice USING (k)),
    each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
             FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

SQL["op9_suffixes"] = """
    WITH d AS (
      SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
      FROM documents),
    strings AS (
      SELECT doc_id, i, md5(substring(h, 2 * i + 1, 200)) AS s
      FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d)),
    later AS (
      SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM strings)
      WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS i FROM later),
    runs AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone),
    removed AS (SELECT doc_id, count(*) AS n_removed,
                       count(*) FILTER (before IS NULL OR before <> i - 1) AS n_spans
                FROM runs GROUP BY doc_id),
    each AS (SELECT doc_id, h, unnest(range(0, n)) AS i FROM d),
    kept AS (SELECT doc_id, string_agg(substring(h, 2 * i + 1, 2), '' ORDER BY i) AS h
             FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
           coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
    FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

SQL["op13_filter_audit"] = r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> '') AS words
      FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
    marked AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
               FROM labels GROUP BY doc_id),
    failing AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
      FROM d JOIN firsts USING (text) LEFT JOIN marked USING (doc_id)),
    orders(filter_order) AS (
      SELECT '' UNION ALL
      SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f)
      WHERE NOT contains(filter_order, f)),
    steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE len(filter_order) = 5),
    sets AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
             FROM failing GROUP BY part, fails),
    met AS (
      SELECT part, filter_order, step, substring(filter_order, step::INT, 1) AS f, fails, n, good, toxic,
             contains(fails, substring(filter_order, step::INT, 1)) AS here,
             len(translate(fails, left(filter_order, step::INT - 1), '')) < len(fails) AS before
      FROM sets, steps),
    counted AS (
      SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (NOT here AND NOT before), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (here AND NOT before), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (here AND before), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (here AND NOT before), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT before), 0)::BIGINT AS toxic_lost
      FROM met GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
           toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM counted"""

SQL["op12_conversations"] = r"""
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
      FROM conversations),
    -- crc32 of the key, byte by byte and bit by bit (256: a shift)
    coded AS (
      SELECT *, xor(list_reduce(flatten(list_transform(string_split(key, ''), lambda c: [
                 ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256])),
               lambda crc, x: CASE WHEN x < 256 THEN xor(crc, x)
                              ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END,
               4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind
      FROM keyed),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM coded, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
             rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare FROM damaged),
    faulty AS (
      SELECT *, left(role, 1) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
             CASE WHEN bare = '' THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
                  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
      FROM placed),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
             count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faulty GROUP BY conv_id),
    -- The best way on (cost, initials, lines) from each state: nothing yet, after s, u, a.
    walk AS (
      SELECT conv_id, n AS k, {'c': 0, 's': '', 'r': []::VARCHAR[]} AS t0,
             {'c': 10, 's': 'II', 'r': ['user:', 'assistant:']} AS t1,
             {'c': 5, 's': 'I', 'r': ['assistant:']} AS t2, {'c': 0, 's': '', 'r': []::VARCHAR[]} AS t3
      FROM (SELECT DISTINCT conv_id, n FROM faulty)
      UNION ALL
      SELECT conv_id, k - 1,
        list_min(b0 || list_transform(b2, lambda x: {'c': x.c + 5, 's': 'I' || x.s, 'r': list_prepend('user:', x.r)})),
        list_min(b1 || list_transform(b2, lambda x: {'c': x.c + 5, 's': 'I' || x.s, 'r': list_prepend('user:', x.r)})),
        list_min(b2 || list_transform(b3, lambda x: {'c': x.c + 5, 's': 'I' || x.s, 'r': list_prepend('assistant:', x.r)})),
        list_min(b3 || list_transform(b2, lambda x: {'c': x.c + 5, 's': 'I' || x.s, 'r': list_prepend('user:', x.r)}))
      FROM (
        SELECT conv_id, k,
          CASE WHEN i = 's' AND stays THEN d0 || [{'c': t1.c + more, 's': 'K' || t1.s, 'r': list_prepend(line, t1.r)}]
               WHEN i = 'u' AND stays THEN d0 || to_u ELSE d0 END AS b0,
          CASE WHEN i = 'u' AND stays THEN d1 || to_u ELSE d1 END AS b1,
          CASE WHEN i = 'a' AND stays THEN
               d2 || [{'c': t3.c + more, 's': 'K' || t3.s, 'r': list_prepend(line, t3.r)}] ELSE d2 END AS b2,
          CASE WHEN i = 'u' AND stays THEN d3 || to_u ELSE d3 END AS b3
        FROM (
          SELECT f.*, t0, t1, t2, t3, fault IN (0, 3) AS stays, CASE fault WHEN 3 THEN 5 ELSE 0 END AS more,
            role || ':' || text AS line,
            [{'c': t2.c + more, 's': 'K' || t2.s, 'r': list_prepend(line, t2.r)}] AS to_u,
            CASE WHEN fault IN (0, 3) THEN [{'c': t2.c + more + 1, 's': 'R' || t2.s,
                 'r': list_prepend('user:' || text, t2.r)}] ELSE [] END AS r_u,
            CASE WHEN fault IN (0, 3) THEN [{'c': t3.c + more + 1, 's': 'R' || t3.s,
                 'r': list_prepend('assistant:' || text, t3.r)}] ELSE [] END AS r_a,
            [{'c': t0.c + 2, 's': 'D' || t0.s, 'r': t0.r}] || r_u AS d0,
            [{'c': t1.c + 2, 's': 'D' || t1.s, 'r': t1.r}] || r_u AS d1,
            [{'c': t2.c + 2, 's': 'D' || t2.s, 'r': t2.r}] || r_a AS d2,
            [{'c': t3.c + 2, 's': 'D' || t3.s, 'r': t3.r}] || r_u AS d3
          FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k))),
    found AS (SELECT conv_id, t0 FROM walk WHERE k = 0)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(t0.c, 0)::BIGINT AS cost,
           coalesce(t0.s, '') AS audit, sha256(coalesce(array_to_string(t0.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM o.conv_id"""
