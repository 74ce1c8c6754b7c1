"""Registered queries of the training-data operators and their oracle SQL.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import exact_dedup, filter_audit, fingerprint, html_text, langid, near_dedup, packing, quality, sentencepiece, substring_dedup, toxicity, url_filter, whitening
from quarry.plans.tables import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), special=True)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = "crc32(cast(doc_id AS string)) % 3 = 1"
    models = langid.fit(docs.filter(f"not ({held})"))
    return (langid.predict(docs, models)
            .select("doc_id", F.expr(f"coalesce({held}, false)").alias("held_out"), "lang_pred", "score", "accepted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.labelled_sample(
        docs, table(spark, sf_dir, "labels"), lambda c: F.expr(f"crc32(cast({c} AS string)) % 4 != 2")))
    return toxicity.score(docs, model).select(
        "doc_id", F.expr("coalesce(crc32(cast(doc_id AS string)) % 4 = 2, false)").alias("held_out"), "score",
        F.expr(f"cast(score >= {toxicity.THRESHOLD} AS int)").alias("predicted"), "quoted_weight")


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_html_text": op11_html_text,
    "op12_whitening": op12_whitening,
    "op13_filter_audit": op13_filter_audit,
}

# words of whole texts: maximal runs without space and 0x09-0x0D
_WORDS = r"""list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

ORACLE = {
    # every pair of texts that share a shingle is compared on full sets
    "op1_near_dedup": f"""
        WITH RECURSIVE
        w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
              FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT p.a, p.b, 2 * p.k = x.n + y.n AS same
            FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS k
                  FROM s l JOIN s r ON l.sh = r.sh AND l.doc_id <> r.doc_id GROUP BY 1, 2) p
            JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
            WHERE 100 * p.k >= 75 * (x.n + y.n - p.k)),
        reach(doc_id, low) USING KEY (doc_id) AS (
            SELECT doc_id, doc_id FROM n
            UNION
            SELECT l.b, min(r.low) FROM reach r JOIN links l ON l.a = r.doc_id
            JOIN recurring.reach c ON c.doc_id = l.b
            WHERE r.low < c.low GROUP BY l.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.low, d.doc_id) AS component_id,
               d.doc_id = coalesce(r.low, d.doc_id) AS kept,
               least(d.doc_id, coalesce((SELECT min(b) FROM links l WHERE l.a = d.doc_id AND l.same), d.doc_id)) AS class_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.doc_id = d.doc_id""",
    "op10_substring_dedup": f"""
        WITH w AS MATERIALIZED (
            SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
        win AS MATERIALIZED (
            SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
        rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT doc_id, list(DISTINCT p) AS ps
                 FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win WHERE k IN (SELECT k FROM rep))
                 GROUP BY doc_id),
        kept AS (SELECT t.doc_id, list(t.word ORDER BY t.p) AS ws
                 FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) t
                 LEFT JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) g ON g.doc_id = t.doc_id AND g.p = t.p
                 WHERE g.p IS NULL GROUP BY t.doc_id)
        SELECT w.doc_id, len(w.ws) AS n_words, coalesce(len(g.ps), 0) AS n_removed,
               sha256(coalesce(array_to_string(k.ws, ' '), '')) AS kept_sha256
        FROM w LEFT JOIN gone g ON g.doc_id = w.doc_id LEFT JOIN kept k ON k.doc_id = w.doc_id""",
    # every document, order and step spelled out
    "op13_filter_audit": f"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
                          {_WORDS.format("coalesce(text, '')")} AS ws
                   FROM documents),
        lab AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
                FROM labels GROUP BY doc_id),
        f AS (SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END)
                     || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
                     || (CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) THEN 'C' ELSE '' END)
                     || (CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END)
                     || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END) AS fails
              FROM d LEFT JOIN lab ON lab.doc_id = d.doc_id),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l a, l b, l c, l d, l e
                   WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        each AS (SELECT part, filter_order, good, toxic, fails,
                        coalesce(list_min([strpos(filter_order, z) for z in string_split(fails, '') if z <> '']), 6) AS gone
                 FROM f, orders),
        cells AS (SELECT part, filter_order, step, substr(filter_order, CAST(step AS INTEGER), 1) AS c,
                         count(*) FILTER (WHERE gone > step) AS kept, count(*) FILTER (WHERE gone = step) AS removed,
                         count(*) FILTER (WHERE gone < step AND contains(fails, substr(filter_order, CAST(step AS INTEGER), 1))) AS redundant,
                         count(*) FILTER (WHERE fails = substr(filter_order, CAST(step AS INTEGER), 1)) AS unique_fails,
                         count(*) FILTER (WHERE gone = step AND good) AS good_lost,
                         count(*) FILTER (WHERE gone = step AND toxic) AS toxic_lost
                  FROM each, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY part, filter_order, step)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
        FROM cells""",
    "op5_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
