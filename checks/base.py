"""What the registered queries share: driver tables, the frames derived from them, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triage.functions import policy as po
from spark_triage.functions import text as tx
from spark_triage.operators import pairs as pr
from spark_triage.sources import standins

BRAND = "brand"
LANGUAGES = ("de", "en", "es", "fr")
INTENT_OF_LANG = {
    "en": "delivery_shipping_issue", "fr": "account_access", "de": "positive_feedback",
    "es": "refund_return_dispute",
}

# The invented prose holds none of the default patterns, so the queries pass patterns that it does hold.
OVERRIDE_PATTERNS = (r"\bwhou?\b", r"\bthat\b.{0,30}\b(thou|ofer)\b", r"\bnicht die\b", r"\d{3}-\d")
DEFLECT_PATTERNS = (r"\band the\b", r"\bles?\b.{0,20}\ble\b", r"\bder die\b")
LINK_PATTERN = r"\bthe (of|in|and)\b"
VOCAB_PATTERNS = (r"\bfor\s+the\b", r"\bof\s+for\b")
ALLOWED_NAMES = ("The", "In", "Der")
GREETINGS = ("The", "And", "Que", "Der")
HIGH_RISK = ("q0t0", "q0t1")

W = r"\p{L}\p{N}_"
OVERRIDE_SQL = (
    rf"(?i)(^|[^{W}])whou?($|[^{W}])",
    rf"(?i)(^|[^{W}])that([^{W}\n]|[^{W}\n].{{0,28}}[^{W}\n])(thou|ofer)($|[^{W}])",
    rf"(?i)(^|[^{W}])nicht die($|[^{W}])",
    r"\p{Nd}{3}-\p{Nd}",
)
DEFLECT_SQL = (
    rf"(?i)(^|[^{W}])and the($|[^{W}])",
    rf"(?i)(^|[^{W}])les?([^{W}\n]|[^{W}\n].{{0,18}}[^{W}\n])le($|[^{W}])",
    rf"(?i)(^|[^{W}])der die($|[^{W}])",
)
LINK_SQL = rf"(?i)(^|[^{W}])the (of|in|and)($|[^{W}])"
VOCAB_SQL = (rf"(?i)(^|[^{W}])for[{tx.SPACE}]+the($|[^{W}])", rf"(?i)(^|[^{W}])of[{tx.SPACE}]+for($|[^{W}])")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to process, as its files give it."""
    return load(spark, sf_dir, name)


# ---- frames ---------------------------------------------------------------------------------------


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.messages_from_turns(load(spark, sf_dir, "conversations"), BRAND)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.build_pairs(messages(spark, sf_dir), BRAND)


def clean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.add_clean_columns(pairs(spark, sf_dir), LINK_PATTERN)


def hundredths(base: int, n: Column, span: int) -> Column:
    return (F.lit(base) + n % span) / F.lit(100.0)


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows: labelled documents with a rule in place of the model."""
    docs = texts(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    text, n = F.col("text"), F.col("n_chars")
    category = (
        F.when(F.col("source") == "src0", "fraud_keyword").when(F.col("source") == "src1", "near_verbatim_stress")
        .when(F.col("source") == "src2", "pay_for_vocab_overlap")
        .when(F.col("source") == "src3", "low_retrieval_similarity").otherwise("")
    )
    rows = docs.select(
        F.col("doc_id").alias("customer_tweet_id"), "lang", category.alias("hard_case_category"),
        text.alias("tweet_text"), text.alias("drafted_reply"),
        F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic")).alias("true_intent"),
        F.when(F.col("toxic") == 1, "escalate").otherwise("auto").alias("true_escalation_decision"),
        F.concat(F.lit("q"), F.when(n >= 600, "1").otherwise("0"), F.lit("t"),
                 F.when(n % 7 == 0, "1").otherwise("0")).alias("predicted_intent"),
        F.concat(F.lit("q"), F.when(n >= 300, "1").otherwise("0"), F.lit("t0")).alias("simple_intent"),
        hundredths(70, n, 29).alias("predicted_confidence"), hundredths(60, n, 37).alias("similarity"),
        tx.fraud_override(text, OVERRIDE_PATTERNS).alias("fraud_override"),
        po.validate_draft(text, allowlist=ALLOWED_NAMES).alias("validate_draft_flags"),
        n.alias("n_chars"),
    )
    decided = po.decide(
        F.col("predicted_intent"), F.col("predicted_confidence"), F.col("fraud_override"), F.col("similarity"),
        F.col("validate_draft_flags"), HIGH_RISK, 0.75, 0.65,
    )
    return rows.withColumn("d", decided).select(
        "*", F.col("d.decision").alias("escalation_decision"), F.col("d.reason").alias("escalation_reason")
    ).drop("d")


def judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge scores of the good-quality labelled documents."""
    docs = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")
    n = F.col("n_chars")
    return docs.select(
        F.col("doc_id").alias("customer_tweet_id"),
        (1 + n % 5).cast("double").alias("relevance_score"),
        (1 + (n + F.col("doc_id") % 3) % 5).cast("double").alias("groundedness_score"),
        (1 + (n * 2) % 5).cast("double").alias("tone_match_score"),
        (1 + (n + F.col("doc_id")) % 4).cast("double").alias("no_hallucinated_specifics_score"),
        F.when(F.col("lang") == "es", F.lit(None)).otherwise(1 + n % 3).cast("double").alias("actionability_score"),
    )


def human(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human scores of all labelled documents."""
    docs = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    n = F.col("n_chars")
    return docs.select(
        F.col("doc_id").alias("customer_tweet_id"),
        (1 + (n + F.col("toxic")) % 5).cast("double").alias("relevance_score"),
        (1 + n % 5).cast("double").alias("groundedness_score"),
        (1 + F.col("doc_id") % 5).cast("double").alias("tone_match_score"),
        (1 + (n + F.col("doc_id") % 3) % 4).cast("double").alias("no_hallucinated_specifics_score"),
        F.when(F.col("lang") == "fr", F.lit(None)).otherwise(1 + (n + F.col("doc_id") % 2) % 4).cast("double")
        .alias("actionability_score"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings")


def queries_and_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every vector is in the corpus; the queries are the same vectors read backwards, also of unit length."""
    corpus = vectors(spark, sf_dir)
    return corpus.withColumn("embedding", F.reverse("embedding")), corpus


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification answers for every document: (id, attempt, raw), some of them unusable."""
    docs = load(spark, sf_dir, "documents")
    n = F.col("n_chars")
    intent = F.element_at(F.create_map(*[F.lit(x) for kv in INTENT_OF_LANG.items() for x in kv]), F.col("lang"))
    conf = F.concat(F.lit("0."), (F.lit(70) + n % 29).cast("string"))
    good = F.concat(F.lit('{"intent":"'), intent, F.lit('","confidence":'), conf, F.lit("}"))
    kind = n % 7
    first = (
        F.when(kind == 0, good).when(kind == 1, F.concat(F.lit("Sure! "), good, F.lit(" hope this helps")))
        .when(kind == 2, F.lit("not json")).when(kind == 3, F.lit('{"intent":"unknown","confidence":0.9}'))
        .when(kind == 4, F.concat(F.lit('{"intent":"'), intent, F.lit('","confidence":"'), conf, F.lit('"}')))
        .when(kind == 5, F.concat(F.lit('{"intent":"'), intent, F.lit('","confidence":"high"}')))
        .otherwise(F.concat(F.lit("{"), good, F.lit("}")))
    )
    second = F.when(n % 3 == 0, good).when(n % 3 == 1, F.concat(good, F.lit(" and {"), good, F.lit("}")))
    retried = kind.isin(2, 3, 6) & (n % 3 != 2)
    answers = F.array_compact(F.array(
        F.struct(F.lit(1).alias("attempt"), first.alias("raw")),
        F.when(retried, F.struct(F.lit(2).alias("attempt"), second.alias("raw"))),
    ))
    return docs.select(F.col("doc_id").alias("id"), F.explode(answers).alias("a")).select("id", "a.attempt", "a.raw")


def judge_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge answers for every document, some with a score out of range, a blank rationale or no JSON."""
    n = F.col("n_chars")

    def part(name: str, score: Column, why: Column) -> Column:
        return F.concat(F.lit(f'"{name}":{{"score":'), score.cast("string"), F.lit(',"rationale":"'), why, F.lit('"}'))

    why = F.concat(F.lit("length "), n.cast("string"))
    body = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            part("relevance", 1 + n % 5, why), part("groundedness", n % 6, why), part("tone_match", 1 + n % 4, why),
            part("no_hallucinated_specifics", 1 + n % 3, F.when(n % 11 == 0, F.lit("")).otherwise(why)),
            part("actionability", 1 + n % 2, why),
        ),
        F.lit("}"),
    )
    raw = F.when(n % 13 == 0, F.lit("no score today")).when(n % 2 == 0, F.concat(F.lit("Here: "), body)).otherwise(body)
    return load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(1).alias("attempt"), raw.alias("raw"))


# ---- the same in SQL --------------------------------------------------------------------------------


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def names_in(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def sql_any(text: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {quote(p)})" for p in patterns) + ")"


def sql_unescape(text: str) -> str:
    """The entities the pages hold; the ampersand comes last."""
    for name, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, {quote(name)}, {quote(char)})"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def sql_redact(text: str) -> str:
    s = tx.SPACE
    text = rf"regexp_replace({text}, '[{W}.+\-]+@[{W}\-]+\.[{W}.\-]+', '<EMAIL>', 'g')"
    return rf"regexp_replace({text}, '\+?\p{{Nd}}[\p{{Nd}}\-.{s}]{{7,}}\p{{Nd}}', '<PHONE>', 'g')"


def sql_squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{tx.SPACE}]+', ' ', 'g'))"


def sql_clean(text: str) -> str:
    text = sql_redact(sql_unescape(text))
    text = f"regexp_replace({text}, 'https?://[^{tx.SPACE}]+', '<URL>', 'g')"
    return sql_squeeze(f"regexp_replace({text}, '@[{W}]+', '', 'g')")


def sql_names(text: str, greetings=GREETINGS, allowed=ALLOWED_NAMES) -> str:
    """Sorted name leaks. Punctuation is doubled so that one match cannot use up the mark the next needs."""
    flat = f"regexp_replace({text}, '[{tx.SPACE}]+', ' ', 'g')"
    inside = (
        rf"regexp_extract_all(regexp_replace({flat}, '([,!])', '\1\1', 'g'), "
        rf"'([^.!?\"'' ] |[^.!?\"'' {W}])([A-Z][a-zA-Z]+)[,!]', 2)"
    )
    greeted = f"regexp_extract_all({flat}, '(^|[^{W}])({'|'.join(greetings)}),? ([A-Z][a-zA-Z]+)', 3)"
    return (
        f"list_sort(list_filter(list_distinct(list_concat({greeted}, {inside})), "
        f"lambda x: x NOT IN {names_in(allowed)}))"
    )


def sql_overlap(a: str, b: str) -> str:
    ta, tb = (f"list_distinct(regexp_extract_all(lower({x}), '[a-z0-9'']+'))" for x in (a, b))
    return (
        f"CASE WHEN len({ta}) = 0 OR len({tb}) = 0 THEN 0.0::DOUBLE "
        f"ELSE len(list_intersect({ta}, {tb}))::DOUBLE / least(len({ta}), len({tb})) END"
    )


MESSAGES_SQL = """messages AS (
  SELECT conv_id * 4294967296 + turn AS tweet_id,
         CASE WHEN role = 'assistant' THEN 'brand' ELSE 'cust' || conv_id END AS author_id,
         role = 'user' AS inbound, NULL::VARCHAR AS created_at, text,
         lag(conv_id * 4294967296 + turn) OVER (PARTITION BY conv_id ORDER BY turn) AS in_response_to_tweet_id
  FROM conversations WHERE role <> 'system')"""

PAIRS_SQL = MESSAGES_SQL + """, pairs AS (
  SELECT c.tweet_id AS customer_tweet_id, c.text AS customer_tweet, c.created_at AS customer_created_at,
         c.in_response_to_tweet_id AS customer_in_response_to_tweet_id, r.tweet_id AS brand_reply_id,
         r.text AS brand_reply, r.created_at AS brand_created_at
  FROM messages r JOIN messages c ON r.in_response_to_tweet_id = c.tweet_id
  WHERE r.author_id = 'brand' AND c.inbound)"""

CLEAN_SQL = PAIRS_SQL + f""", clean_pairs AS (
  SELECT *, coalesce(regexp_matches(brand_reply, {quote(LINK_SQL)}), false) AS has_link,
         {sql_clean('customer_tweet')} AS customer_tweet_clean, {sql_clean('brand_reply')} AS brand_reply_clean
  FROM pairs)"""

_NAME_LIST = (
    "'[' || array_to_string(list_transform(names, lambda x: '\"name used in draft: ''' || x || "
    "''' (names are banned by policy)\"'), ', ') || ']'"
)


def sql_decide(intent: str, conf: str, override: str, sim: str, flagged: str, flag_text: str,
               high_risk=HIGH_RISK, min_conf: float = 0.75, min_sim: float = 0.65) -> tuple[str, str]:
    """(decision, reason) as SQL expressions."""
    risky = f"{intent} IN {names_in(high_risk)}"
    low = f"({conf} < {min_conf}::DOUBLE OR {sim} < {min_sim}::DOUBLE)"
    decision = f"CASE WHEN {override} OR {risky} OR {flagged} OR {low} THEN 'escalate' ELSE 'auto' END"
    reason = f"""CASE WHEN {override} THEN 'security/fraud keyword match'
      WHEN {risky} THEN 'high-risk intent ''' || {intent} || ''': requires human for account/money/trust action, regardless of confidence'
      WHEN {flagged} THEN 'generated reply failed automated safety validation: ' || {flag_text}
      WHEN {low} THEN concat_ws('; ',
        CASE WHEN {conf} < {min_conf}::DOUBLE THEN 'confidence ' || printf('%.2f', {conf}) || ' < {min_conf}' END,
        CASE WHEN {sim} < {min_sim}::DOUBLE THEN 'retrieval_top1_similarity ' || printf('%.2f', {sim}) || ' < {min_sim}' END)
      ELSE 'confidence ' || printf('%.2f', {conf}) || ' >= {min_conf} and similarity ' || printf('%.2f', {sim}) || ' >= {min_sim}' END"""
    return decision, reason


_DECISION, _REASON = sql_decide(
    "predicted_intent", "predicted_confidence", "fraud_override", "similarity", "len(names) > 0", _NAME_LIST
)

GOLDEN_SQL = f"""golden_base AS (
  SELECT doc_id AS customer_tweet_id, lang, n_chars,
         CASE source WHEN 'src0' THEN 'fraud_keyword' WHEN 'src1' THEN 'near_verbatim_stress'
              WHEN 'src2' THEN 'pay_for_vocab_overlap' WHEN 'src3' THEN 'low_retrieval_similarity' ELSE '' END AS hard_case_category,
         text AS tweet_text, text AS drafted_reply, 'q' || quality || 't' || toxic AS true_intent,
         CASE WHEN toxic = 1 THEN 'escalate' ELSE 'auto' END AS true_escalation_decision,
         'q' || CASE WHEN n_chars >= 600 THEN '1' ELSE '0' END || 't' || CASE WHEN n_chars % 7 = 0 THEN '1' ELSE '0' END AS predicted_intent,
         'q' || CASE WHEN n_chars >= 300 THEN '1' ELSE '0' END || 't0' AS simple_intent,
         (70 + n_chars % 29) / 100::DOUBLE AS predicted_confidence, (60 + n_chars % 37) / 100::DOUBLE AS similarity,
         {sql_any('text', OVERRIDE_SQL)} AS fraud_override,
         {sql_names('text', greetings=('Hi', 'Hello', 'Hey', 'Dear'))} AS names
  FROM documents JOIN labels USING (doc_id)),
golden AS (SELECT *, {_DECISION} AS escalation_decision, {_REASON} AS escalation_reason FROM golden_base)"""

JUDGE_SQL = """judge AS (
  SELECT doc_id AS customer_tweet_id, (1 + n_chars % 5)::DOUBLE AS relevance_score,
         (1 + (n_chars + doc_id % 3) % 5)::DOUBLE AS groundedness_score, (1 + (n_chars * 2) % 5)::DOUBLE AS tone_match_score,
         (1 + (n_chars + doc_id) % 4)::DOUBLE AS no_hallucinated_specifics_score,
         CASE WHEN lang = 'es' THEN NULL ELSE 1 + n_chars % 3 END::DOUBLE AS actionability_score
  FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"""

HUMAN_SQL = """human AS (
  SELECT doc_id AS customer_tweet_id, (1 + (n_chars + toxic) % 5)::DOUBLE AS relevance_score,
         (1 + n_chars % 5)::DOUBLE AS groundedness_score, (1 + doc_id % 5)::DOUBLE AS tone_match_score,
         (1 + (n_chars + doc_id % 3) % 4)::DOUBLE AS no_hallucinated_specifics_score,
         CASE WHEN lang = 'fr' THEN NULL ELSE 1 + (n_chars + doc_id % 2) % 4 END::DOUBLE AS actionability_score
  FROM documents JOIN labels USING (doc_id))"""

_INTENT_CASE = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INTENT_OF_LANG.items()) + " END"

RESPONSES_SQL = f"""answered AS (
  SELECT doc_id AS id, n_chars, {_INTENT_CASE} AS intent, '0.' || (70 + n_chars % 29) AS conf,
         '{{"intent":"' || {_INTENT_CASE} || '","confidence":0.' || (70 + n_chars % 29) || '}}' AS good
  FROM documents),
responses AS (
  SELECT id, 1 AS attempt, CASE n_chars % 7
           WHEN 0 THEN good WHEN 1 THEN 'Sure! ' || good || ' hope this helps' WHEN 2 THEN 'not json'
           WHEN 3 THEN '{{"intent":"unknown","confidence":0.9}}'
           WHEN 4 THEN '{{"intent":"' || intent || '","confidence":"' || conf || '"}}'
           WHEN 5 THEN '{{"intent":"' || intent || '","confidence":"high"}}'
           ELSE '{{' || good || '}}' END AS raw FROM answered
  UNION ALL
  SELECT id, 2, CASE n_chars % 3 WHEN 0 THEN good ELSE good || ' and {{' || good || '}}' END FROM answered
  WHERE n_chars % 7 IN (2, 3, 6) AND n_chars % 3 <> 2),
bodies AS (SELECT *, regexp_extract(raw, '(?s)\\{{.*\\}}', 0) AS body FROM responses),
objects AS (SELECT *, CASE WHEN body <> '' AND json_valid(body) THEN body END AS obj FROM bodies),
fields AS (SELECT id, attempt, obj, json_extract_string(obj, '$.intent') AS said, json_extract_string(obj, '$.confidence') AS conf
           FROM objects),
parsed AS (SELECT *, CASE
    WHEN said IS NULL OR conf IS NULL OR said NOT IN ('delivery_shipping_issue', 'refund_return_dispute', 'account_access',
      'billing_subscription_dispute', 'digital_service_device_support', 'marketplace_seller_trust', 'positive_feedback',
      'general_complaint_other') THEN 'retry'
    WHEN try_cast(conf AS DOUBLE) IS NULL THEN 'failed' ELSE 'ok' END AS status FROM fields)"""

VECTORS_SQL = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
sims AS (SELECT q.vec_id AS query_id, q.label AS query_label, c.vec_id AS corpus_id, c.label AS corpus_label,
                round(list_dot_product(list_reverse(q.e), c.e), 9) AS similarity FROM v q, v c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS rank FROM sims)"""


def lang_sql(target: str, id_col: str, text_col: str) -> str:
    """detected(id, detected) for ``target``, with the profile of the labelled documents."""

    def grams(table: str, key: str, col: str, extra: str = "") -> str:
        return (
            f"SELECT {key}{extra}, unnest(list_transform(range(1, len(p) - 1), lambda i: p[i] || p[i + 1] || p[i + 2])) AS g FROM "
            f"(SELECT {key}{extra}, string_split(' ' || t || ' ', '') AS p FROM (SELECT {key}{extra}, "
            f"trim(regexp_replace(lower({col}), '[^\\p{{L}}]+', ' ', 'g')) AS t FROM {table}) WHERE t <> '')"
        )

    return f"""train AS ({grams('documents', 'doc_id', 'text', ', lang')}),
top AS (SELECT lang, g, count(*) AS n FROM train GROUP BY lang, g),
z AS (SELECT lang, ln((sum(n) + (SELECT count(DISTINCT g) FROM top))::DOUBLE) AS z FROM top GROUP BY lang),
seen AS ({grams(target, id_col, text_col)}),
sizes AS (SELECT {id_col}, count(*) AS n_grams FROM seen GROUP BY 1),
hits AS (SELECT {id_col}, top.lang, sum(ln((n + 1)::DOUBLE)) AS s FROM seen JOIN top USING (g) GROUP BY 1, 2),
scored AS (SELECT s.{id_col}, z.lang, coalesce(h.s, 0) - n_grams * z AS score
           FROM sizes s CROSS JOIN z LEFT JOIN hits h ON h.{id_col} = s.{id_col} AND h.lang = z.lang
           WHERE s.{id_col} IN (SELECT {id_col} FROM hits)),
best AS (SELECT {id_col}, lang FROM (SELECT *, row_number() OVER (PARTITION BY {id_col} ORDER BY score DESC, lang) AS r FROM scored) WHERE r = 1),
detected AS (SELECT t.{id_col}, best.lang AS detected FROM {target} t LEFT JOIN best USING ({id_col}))"""
