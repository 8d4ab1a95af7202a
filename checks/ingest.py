"""Queries on messages, pairs, cleaning, language and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import base as b
from checks.base import load, quote, sql_any, sql_clean, sql_redact, sql_unescape, texts
from spark_triage.functions import text as tx
from spark_triage.operators import language as lg
from spark_triage.operators import pairs as pr
from spark_triage.operators import profile as pf
from spark_triage.operators import sampling as sm
from spark_triage.plans import discover, ingest
from spark_triage.session import shared_folder, staged
from spark_triage.sources import tables

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


# ---- scans, pairs -----------------------------------------------------------------------------------


@query("WITH " + b.MESSAGES_SQL + " SELECT * FROM messages")
def scan_messages(spark, d):
    raw = b.messages(spark, d).select(
        F.col("tweet_id").cast("string").alias("tweet_id"), "author_id",
        F.initcap(F.col("inbound").cast("string")).alias("inbound"), "created_at", "text",
        # Parent ids as a CSV writer leaves them: "12.0", or a word where there is none.
        F.coalesce(F.concat(F.col("in_response_to_tweet_id").cast("string"), F.lit(".0")), F.lit("none"))
        .alias("in_response_to_tweet_id"),
    )
    return tables.typed_messages(raw)


@query("WITH " + b.MESSAGES_SQL + " SELECT * FROM messages")
def csv_messages(spark, d):
    """The messages written as CSV files, with a column too many and parent ids like 12.0, and read back typed."""
    rows = b.messages(spark, d).select(
        "tweet_id", "author_id", F.initcap(F.col("inbound").cast("string")).alias("inbound"), "created_at", "text",
        F.lit("x,y").alias("response_tweet_id"),
        F.concat(F.col("in_response_to_tweet_id").cast("string"), F.lit(".0")).alias("in_response_to_tweet_id"),
    )
    path = f"{shared_folder(spark)}/messages-{uuid.uuid4().hex}"
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return tables.read_messages_csv(spark, path)


@query("WITH " + b.PAIRS_SQL + " SELECT * FROM pairs")
def build_pairs(spark, d):
    return b.pairs(spark, d)


@query("WITH " + b.PAIRS_SQL + " SELECT * FROM pairs WHERE customer_in_response_to_tweet_id IS NULL")
def first_touch(spark, d):
    return pr.first_touch(b.pairs(spark, d))


@query("WITH " + b.CLEAN_SQL + """ SELECT customer_tweet_id, customer_created_at, customer_in_response_to_tweet_id,
  brand_reply_id, brand_created_at, has_link, customer_tweet_clean, brand_reply_clean FROM clean_pairs""")
def publish_projection(spark, d):
    return tables.publishable(b.clean_pairs(spark, d))


@query("WITH " + b.MESSAGES_SQL + """ SELECT author_id, count(*) AS n_replies FROM messages WHERE NOT inbound
  GROUP BY 1 ORDER BY n_replies DESC, author_id LIMIT 10""")
def brand_volume(spark, d):
    return pf.brand_volume(b.messages(spark, d), 10)


@query("WITH " + b.PAIRS_SQL + """ SELECT tweet_id, text FROM messages m WHERE inbound AND NOT EXISTS
  (SELECT 1 FROM pairs p WHERE p.customer_tweet_id = m.tweet_id)""")
def resume_delta(spark, d):
    """Inbound messages that no reply covers yet."""
    done = b.pairs(spark, d).select(F.col("customer_tweet_id").alias("tweet_id"))
    return tables.remaining(b.messages(spark, d).filter("inbound"), done, "tweet_id").select("tweet_id", "text")


# ---- flags and rates --------------------------------------------------------------------------------


@query("WITH " + b.PAIRS_SQL + f" SELECT brand_reply_id, {sql_any('brand_reply', b.DEFLECT_SQL)} AS deflected FROM pairs")
def deflection_flag(spark, d):
    return b.pairs(spark, d).select(
        "brand_reply_id", tx.deflection_flag(F.col("brand_reply"), b.DEFLECT_PATTERNS).alias("deflected")
    )


@query("WITH " + b.PAIRS_SQL + f""", f AS (SELECT {sql_any('brand_reply', b.DEFLECT_SQL)} AS x FROM pairs)
  SELECT count(*) AS n, count_if(x)::BIGINT AS n_deflected, avg(x::INT)::DOUBLE AS rate FROM f""")
def deflection_rate(spark, d):
    return pf.deflection_rate(b.pairs(spark, d), b.DEFLECT_PATTERNS)


@query("WITH " + b.PAIRS_SQL + f""", f AS (SELECT *, {sql_any('brand_reply', b.DEFLECT_SQL)} AS flag FROM pairs)
  SELECT flag, min(brand_reply_id) AS brand_reply_id, arg_min(brand_reply, brand_reply_id) AS brand_reply FROM f GROUP BY flag""")
def deflection_examples(spark, d):
    flag = tx.deflection_flag(F.col("brand_reply"), b.DEFLECT_PATTERNS)
    return pf.flag_examples(b.pairs(spark, d), flag, "brand_reply", "brand_reply_id")


@query("WITH " + b.PAIRS_SQL + f" SELECT brand_reply_id, coalesce(regexp_matches(brand_reply, {quote(b.LINK_SQL)}), false) AS has_link FROM pairs")
def has_link(spark, d):
    return b.pairs(spark, d).select("brand_reply_id", tx.has_link(F.col("brand_reply"), b.LINK_PATTERN).alias("has_link"))


@query("WITH " + b.CLEAN_SQL + """ SELECT brand_reply_id, brand_reply_clean FROM clean_pairs
  WHERE NOT has_link AND length(brand_reply_clean) >= 400""")
def substance_filter(spark, d):
    return pr.substance_filter(b.clean_pairs(spark, d), 400).select("brand_reply_id", "brand_reply_clean")


@query(f"SELECT doc_id, {sql_any('text', b.OVERRIDE_SQL)} AS fraud_override FROM documents")
def fraud_override(spark, d):
    return texts(spark, d, "documents").select(
        "doc_id", tx.fraud_override(F.col("text"), b.OVERRIDE_PATTERNS).alias("fraud_override")
    )


@query("SELECT doc_id, concat_ws(' ', " + ", ".join(
    f"CASE WHEN regexp_matches(text, {quote(s)}) THEN {quote(p)} END" for p, s in zip(b.OVERRIDE_PATTERNS, b.OVERRIDE_SQL)
) + ") AS fired FROM documents")
def override_matches(spark, d):
    fired = tx.matched_patterns(F.col("text"), b.OVERRIDE_PATTERNS)
    return texts(spark, d, "documents").select("doc_id", F.array_join(fired, " ").alias("fired"))


@query(f"SELECT doc_id, {sql_any('text', b.VOCAB_SQL)} AS pay_for_match FROM documents")
def vocab_overlap(spark, d):
    return texts(spark, d, "documents").select(
        "doc_id", tx.vocab_overlap(F.col("text"), b.VOCAB_PATTERNS).alias("pay_for_match")
    )


# ---- text functions ---------------------------------------------------------------------------------


@query(f"SELECT page_id, {sql_unescape('html')} AS html FROM pages")
def unescape_html(spark, d):
    return texts(spark, d, "pages").select("page_id", tx.unescape_html(F.col("html")).alias("html"))


@query(f"SELECT doc_id, {sql_redact('text')} AS text FROM documents")
def redact_pii(spark, d):
    return texts(spark, d, "documents").select("doc_id", tx.redact_pii(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {sql_clean('text')} AS text FROM documents")
def clean_text(spark, d):
    return texts(spark, d, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("text"))


@query(f"SELECT page_id, {sql_clean('html')} AS html FROM pages")
def clean_pages(spark, d):
    """The same cleaning over raw pages, which hold entities and links."""
    return texts(spark, d, "pages").select("page_id", tx.clean_text(F.col("html")).alias("html"))


@query(f"SELECT doc_id, {b.sql_squeeze(chr(39).join(['regexp_replace(text, ', r'\^[A-Z]{2,3}($|[^' + b.W + '])', ', ', '', ', ', 'g', ')']))} AS text FROM documents")
def clean_reply(spark, d):
    return texts(spark, d, "documents").select("doc_id", tx.clean_reply(F.col("text")).alias("text"))


@query(f"SELECT doc_id, array_to_string({b.sql_names('text')}, ',') AS names FROM documents")
def name_leaks(spark, d):
    leaks = tx.name_leaks(F.col("text"), b.ALLOWED_NAMES, b.GREETINGS)
    return texts(spark, d, "documents").select("doc_id", F.array_join(leaks, ",").alias("names"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9'']+'))), ' ') AS tokens
  FROM documents""")
def token_set(spark, d):
    return texts(spark, d, "documents").select(
        "doc_id", F.array_join(F.array_sort(tx.token_set(F.col("text"))), " ").alias("tokens")
    )


@query("WITH " + b.PAIRS_SQL + f" SELECT brand_reply_id, {b.sql_overlap('brand_reply', 'customer_tweet')} AS overlap FROM pairs")
def token_overlap(spark, d):
    return b.pairs(spark, d).select(
        "brand_reply_id", tx.token_overlap(F.col("brand_reply"), F.col("customer_tweet")).alias("overlap")
    )


# ---- profiles ---------------------------------------------------------------------------------------


@query("WITH " + b.PAIRS_SQL + """, l AS (SELECT length(brand_reply) AS len FROM pairs)
  SELECT count(*) AS n, round_even(avg(len), 1) AS mean, round_even(stddev_samp(len), 1) AS std, min(len) AS min,
    round_even(quantile_cont(len, 0.25), 1) AS q1, round_even(quantile_cont(len, 0.5), 1) AS median,
    round_even(quantile_cont(len, 0.75), 1) AS q3, max(len) AS max FROM l""")
def reply_length_profile(spark, d):
    return pf.length_profile(b.pairs(spark, d), "brand_reply")


_CHANGED = "count_if({r} <> {u})::BIGINT"


@query("WITH " + b.PAIRS_SQL + f""" SELECT {_CHANGED.format(r=sql_redact(sql_unescape('text')), u=sql_unescape('text'))} AS text_rows,
  {_CHANGED.format(r=sql_redact('source'), u='source')} AS source_rows FROM documents""")
def pii_affected(spark, d):
    return pf.pii_affected(texts(spark, d, "documents"), ["text", "source"])


_RESIDUE = rf"[{b.W}.+\-]+@[{b.W}\-]+\.[{b.W}.\-]+|\+?\p{{Nd}}[\p{{Nd}}\-.{tx.SPACE}]{{7,}}\p{{Nd}}"


@query(f"""SELECT count_if(regexp_matches(text, '{_RESIDUE}'))::BIGINT AS text_rows,
  count_if(regexp_matches({sql_clean('text')}, '{_RESIDUE}'))::BIGINT AS clean_rows FROM documents""")
def pii_residue_audit(spark, d):
    docs = texts(spark, d, "documents").select("text", tx.clean_text(F.col("text")).alias("clean"))
    return pf.pii_residue(docs, ["text", "clean"])


@query("WITH " + b.CLEAN_SQL + " SELECT count(DISTINCT brand_reply_clean) AS n_templates FROM clean_pairs")
def template_count(spark, d):
    return b.clean_pairs(spark, d).agg(F.count_distinct("brand_reply_clean").alias("n_templates"))


# ---- language ---------------------------------------------------------------------------------------


def _detected_documents(spark, d):
    docs = texts(spark, d, "documents")
    profile = lg.language_profile(docs, "text", "lang", b.LANGUAGES)
    return lg.detect_language(docs, "text", profile, b.LANGUAGES)


_DOC_LANG = "WITH " + b.lang_sql("documents", "doc_id", "text")


@query(_DOC_LANG + " SELECT doc_id, detected FROM detected")
def detect_language(spark, d):
    return _detected_documents(spark, d).select("doc_id", "detected")


@query(_DOC_LANG + " SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM detected WHERE detected = 'en')")
def language_filter(spark, d):
    return lg.language_filter(_detected_documents(spark, d)).select("doc_id", "text")


@query(_DOC_LANG + """ SELECT count_if(detected IS NULL)::BIGINT AS n_errored, count_if(detected <> 'en')::BIGINT AS n_other,
  count_if(detected = 'en')::BIGINT AS n_kept FROM detected""")
def language_outcomes(spark, d):
    return pf.language_outcomes(_detected_documents(spark, d))


def _profile(spark, d):
    return lg.language_profile(texts(spark, d, "documents"), "text", "lang", b.LANGUAGES)


_P2_SQL = "WITH " + b.CLEAN_SQL + """, openers AS (SELECT * FROM clean_pairs WHERE customer_in_response_to_tweet_id IS NULL), """ + \
    b.lang_sql("openers", "brand_reply_id", "customer_tweet_clean") + """,
en AS (SELECT o.* FROM openers o JOIN detected USING (brand_reply_id) WHERE detected = 'en'),
deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_tweet_clean ORDER BY brand_reply_id) AS r1 FROM en) WHERE r1 = 1),
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand_reply_clean ORDER BY brand_reply_id) AS r2 FROM deduped) WHERE r2 <= 5)"""


@query(_P2_SQL + """, steps AS (
  SELECT 1 AS step_no, 'pairs' AS step, (SELECT count(*) FROM pairs) AS rows_kept
  UNION ALL SELECT 2, 'first_touch', (SELECT count(*) FROM openers) UNION ALL SELECT 3, 'language', (SELECT count(*) FROM en)
  UNION ALL SELECT 4, 'dedupe', (SELECT count(*) FROM deduped) UNION ALL SELECT 5, 'template_cap', (SELECT count(*) FROM capped)),
 lagged AS (SELECT *, coalesce(lag(rows_kept) OVER (ORDER BY step_no), rows_kept) AS rows_in FROM steps)
 SELECT step_no, step, rows_in, rows_in - rows_kept AS rows_removed, rows_kept FROM lagged""")
def cleaning_funnel(spark, d):
    return ingest.cleaning_funnel(b.pairs(spark, d), _profile(spark, d), b.LANGUAGES, link_pattern=b.LINK_PATTERN)


@query(_P2_SQL + """ SELECT customer_tweet_id, brand_reply_id, has_link, customer_tweet_clean, brand_reply_clean FROM capped""")
def cleaned_pairs(spark, d):
    """Openers, clean, language, de-duplicate, cap, in this order."""
    return ingest.clean(b.pairs(spark, d), _profile(spark, d), b.LANGUAGES, link_pattern=b.LINK_PATTERN).select(
        "customer_tweet_id", "brand_reply_id", "has_link", "customer_tweet_clean", "brand_reply_clean"
    )


# ---- duplicates, caps, samples ------------------------------------------------------------------------


@query("""SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def dedupe_exact(spark, d):
    return pr.drop_duplicates(load(spark, d, "documents"), "text", "doc_id").select("doc_id", "lang", "source")


@query("""SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 5""")
def template_cap(spark, d):
    return pr.cap_templates(load(spark, d, "documents"), 5, "source", "doc_id").select("doc_id", "source", "lang")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 150")
def seeded_sample(spark, d):
    return sm.seeded_sample(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", 42, 150)


_SPLIT = """WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k FROM documents),
 split AS (SELECT doc_id, lang, CASE WHEN k <= 90 THEN 'working' ELSE 'heldout' END AS split FROM r WHERE k <= 130)"""


def _split(spark, d):
    return sm.split_working_heldout(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", 90, 40)


@query(_SPLIT + " SELECT * FROM split")
def split_working_heldout(spark, d):
    return _split(spark, d)


@query(_SPLIT + """ SELECT count(*) AS n_overlap FROM split a JOIN split b USING (doc_id) WHERE a.split = 'working' AND b.split = 'heldout'""")
def split_overlap(spark, d):
    return sm.split_overlap(_split(spark, d), "doc_id")


@query("WITH " + b.CLEAN_SQL + """, w AS (SELECT * FROM clean_pairs ORDER BY md5('42:' || brand_reply_id), brand_reply_id LIMIT 60),
 u AS (SELECT 'full' AS set, * FROM clean_pairs UNION ALL SELECT 'working', * FROM w)
 SELECT set, count(*) AS n, avg(length(brand_reply_clean)) AS mean_len, median(length(brand_reply_clean)) AS median_len,
   avg(has_link::INT) AS link_rate FROM u GROUP BY set""")
def sample_sanity(spark, d):
    full = staged(b.clean_pairs(spark, d), "population")
    return pf.sample_sanity(full, sm.seeded_sample(full, "brand_reply_id", 42, 60))


def _strata(table: str, group: str, key: str, total: str, seed: int) -> str:
    return f"""g AS (SELECT {group}, count(*) AS size, row_number() OVER (ORDER BY {group}) - 1 AS i FROM {table} GROUP BY 1),
 quota AS (SELECT {group}, {total} // (SELECT count(*) FROM g) + CASE WHEN i < {total} % (SELECT count(*) FROM g) THEN 1 ELSE 0 END AS q FROM g),
 picked AS (SELECT t.* FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY md5('{seed}:' || {key}), {key}) AS k FROM {table}) t
   JOIN quota USING ({group}) WHERE k <= q)"""


@query("WITH " + _strata("documents", "source", "doc_id", "45", 33) + " SELECT doc_id, source FROM picked")
def stratified_sample(spark, d):
    return sm.stratified_sample(load(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 45, 33)




@query("WITH listed AS (SELECT * FROM documents WHERE lang || source IN ('ensrc3', 'desrc1')), "
       "others AS (SELECT * FROM documents WHERE lang || source NOT IN ('ensrc3', 'desrc1')), "
       + _strata("others", "lang", "doc_id", "greatest(80 - (SELECT count(*) FROM listed), 0)", 13)
       + " SELECT doc_id, true AS forced FROM listed UNION ALL SELECT doc_id, false FROM picked")
def forced_sample(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "lang", F.concat("lang", "source").alias("tag"))
    return sm.forced_sample(docs, "lang", "doc_id", "tag", ["ensrc3", "desrc1"], 80, 13).select("doc_id", "forced")


@query("""SELECT source, k AS example_no, doc_id, text FROM
  (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id)::INT AS k FROM documents) WHERE k <= 8""")
def cluster_examples(spark, d):
    return discover.cluster_examples(load(spark, d, "documents"), "source", "doc_id", "text")
