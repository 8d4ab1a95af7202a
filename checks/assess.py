"""Queries on responses, drafts, policy, evaluation tables and failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base as b
from checks.base import load, names_in, quote, sql_any, texts
from spark_triage import fixed_values as fv
from spark_triage.functions import policy as po
from spark_triage.functions import prompts as pm
from spark_triage.functions import responses as rs
from spark_triage.functions import text as tx
from spark_triage.operators import evaluate as ev
from spark_triage.operators import failures as fl
from spark_triage.operators import inference as inf
from spark_triage.operators import profile as pf
from spark_triage.operators import retrieval as rt
from spark_triage.plans import assess, triage
from spark_triage.session import staged

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


_G = "WITH " + b.GOLDEN_SQL
_GJ = _G + ", " + b.JUDGE_SQL + ", gj AS (SELECT * FROM golden LEFT JOIN judge USING (customer_tweet_id))"


def _scored(spark, d):
    return fl.golden_with_scores(staged(b.golden(spark, d), "golden"), b.judge(spark, d))


# ---- responses ------------------------------------------------------------------------------------------


@query("WITH " + b.RESPONSES_SQL + """ SELECT id, attempt, obj IS NOT NULL AS found, said AS intent, conf AS confidence FROM fields""")
def extract_json(spark, d):
    parsed = b.responses(spark, d).withColumn("v", rs.extract_json(F.col("raw")))
    return parsed.select(
        "id", "attempt", F.col("v").isNotNull().alias("found"),
        F.try_variant_get("v", "$.intent", "string").alias("intent"),
        F.try_variant_get("v", "$.confidence", "string").alias("confidence"),
    )


@query("WITH " + b.RESPONSES_SQL + """ SELECT id, attempt, CASE WHEN status = 'ok' THEN said END AS intent,
  CASE WHEN status = 'ok' THEN conf::DOUBLE END AS confidence, status FROM parsed""")
def parse_classification(spark, d):
    return b.responses(spark, d).select("id", "attempt", rs.parse_classification(F.col("raw")).alias("p")).select(
        "id", "attempt", "p.*"
    )


_ROUND = "WITH " + b.RESPONSES_SQL + """, a AS (SELECT * FROM parsed WHERE attempt = 1), z AS (SELECT * FROM parsed WHERE attempt = 2),
 used AS (SELECT a.id, a.status AS first, z.status AS second,
   CASE WHEN a.status = 'retry' THEN z.status ELSE a.status END AS status,
   CASE WHEN a.status = 'retry' THEN z.said ELSE a.said END AS said, CASE WHEN a.status = 'retry' THEN z.conf ELSE a.conf END AS conf
   FROM a LEFT JOIN z USING (id)),
 rounds AS (SELECT id, CASE WHEN status = 'ok' THEN said END AS intent, CASE WHEN status = 'ok' THEN conf::DOUBLE END AS confidence,
   CASE WHEN status IS NULL THEN 'retry' WHEN status = 'ok' THEN 'ok' ELSE 'dead' END AS outcome,
   CASE WHEN first = 'retry' AND second IS NOT NULL THEN 2 ELSE 1 END AS attempts FROM used)"""


@query(_ROUND + " SELECT * FROM rounds")
def inference_round(spark, d):
    return inf.classification_round(b.responses(spark, d))


@query("WITH " + b.RESPONSES_SQL + " SELECT attempt, status, count(*) AS n FROM parsed GROUP BY ALL")
def response_health(spark, d):
    parsed = b.responses(spark, d).withColumn("p", rs.parse_classification(F.col("raw")))
    return inf.response_health(parsed, F.col("p.status"))


@query(_ROUND + f""" SELECT id, text || {quote(fv.CLASSIFY_RETRY)} AS prompt FROM rounds JOIN documents ON doc_id = id WHERE outcome = 'retry'""")
def retry_prompts(spark, d):
    prompts = load(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("prompt"))
    return inf.retry_prompts(prompts, inf.classification_round(b.responses(spark, d)))


_JUDGE_OK = "n_chars % 13 <> 0 AND n_chars % 6 BETWEEN 1 AND 5 AND n_chars % 11 <> 0"


@query(f"""SELECT doc_id AS id, 1 AS attempt, {_JUDGE_OK} AS valid,
  CASE WHEN {_JUDGE_OK} THEN (1 + n_chars % 5)::DOUBLE END AS relevance_score, CASE WHEN {_JUDGE_OK} THEN (n_chars % 6)::DOUBLE END AS groundedness_score,
  CASE WHEN {_JUDGE_OK} THEN (1 + n_chars % 4)::DOUBLE END AS tone_match_score,
  CASE WHEN {_JUDGE_OK} THEN (1 + n_chars % 3)::DOUBLE END AS no_hallucinated_specifics_score,
  CASE WHEN {_JUDGE_OK} THEN (1 + n_chars % 2)::DOUBLE END AS actionability_score,
  """ + ", ".join(f"CASE WHEN {_JUDGE_OK} THEN 'length ' || n_chars END AS {x}_rationale" for x in fv.JUDGE_DIMENSIONS) + " FROM documents")
def parse_judge(spark, d):
    return inf.judge_round(b.judge_responses(spark, d))


# ---- drafts and policy -----------------------------------------------------------------------------------


def _checked_replies(spark, d):
    flags = po.validate_draft(F.col("brand_reply"), F.col("customer_tweet"), b.ALLOWED_NAMES, 0.5)
    return b.pairs(spark, d).select("brand_reply_id", flags.alias("validate_draft_flags"))


_OVERLAP = b.sql_overlap("brand_reply", "customer_tweet")
_DRAFT = "WITH " + b.PAIRS_SQL + f""", o AS (SELECT *, {_OVERLAP} AS share, {b.sql_names('brand_reply', greetings=fv.GREETINGS)} AS names FROM pairs),
 f AS (SELECT brand_reply_id, share >= 0.5 AS copied, list_concat(
     list_transform(names, lambda x: '"name used in draft: ''' || x || ''' (names are banned by policy)"'),
     CASE WHEN share >= 0.5 THEN ['''near-verbatim: ' || round_even(share * 100, 0)::INT || '% token overlap with top-1 retrieved reply'''] ELSE [] END) AS msgs FROM o)"""


@query(_DRAFT + " SELECT brand_reply_id, len(msgs)::INT AS n_flags, '[' || array_to_string(msgs, ', ') || ']' AS flags FROM f")
def validate_draft(spark, d):
    return _checked_replies(spark, d).select(
        "brand_reply_id", F.size("validate_draft_flags").alias("n_flags"),
        po.flag_list_text(F.col("validate_draft_flags")).alias("flags"),
    )


@query(_DRAFT + " SELECT count(*) AS n_checked, count_if(copied)::BIGINT AS n_flagged, avg(copied::INT)::DOUBLE AS rate FROM f")
def near_verbatim_rate(spark, d):
    return ev.flag_rate(_checked_replies(spark, d), "near_verbatim", F.lit(True))


@query(_G + " SELECT customer_tweet_id, escalation_decision, escalation_reason FROM golden")
def escalation_decide(spark, d):
    return b.golden(spark, d).select("customer_tweet_id", "escalation_decision", "escalation_reason")


@query(_G + f" SELECT customer_tweet_id, CASE WHEN simple_intent IN {names_in(b.HIGH_RISK)} THEN 'escalate' ELSE 'auto' END AS decision FROM golden")
def escalation_intent_only(spark, d):
    return b.golden(spark, d).select(
        "customer_tweet_id", po.decide_by_intent(F.col("simple_intent"), b.HIGH_RISK).alias("decision")
    )


@query(_G + f""" SELECT count(*) AS n_rows, count_if(escalation_decision = 'auto' AND (fraud_override OR predicted_intent IN {names_in(b.HIGH_RISK)}))::BIGINT AS n_leaked FROM golden""")
def policy_leak_check(spark, d):
    return ev.policy_leaks(b.golden(spark, d), b.HIGH_RISK)


@query(f"""SELECT doc_id, CASE WHEN x THEN 'holding' ELSE 'draft' END AS route, CASE WHEN x THEN {quote(fv.HOLDING_MESSAGE)} END AS drafted_reply,
  CASE WHEN x THEN 0.0::DOUBLE END AS retrieval_top1_similarity, CASE WHEN x THEN 0 END AS n_flags
  FROM (SELECT doc_id, {sql_any('text', b.OVERRIDE_SQL)} AS x FROM documents)""")
def draft_routing(spark, d):
    rows = texts(spark, d, "documents").select(
        "doc_id", tx.fraud_override(F.col("text"), b.OVERRIDE_PATTERNS).alias("fraud_override")
    )
    return inf.draft_routing(rows).select(
        "doc_id", "route", "drafted_reply", "retrieval_top1_similarity", F.size("validate_draft_flags").alias("n_flags")
    )


_DRAFT_HEAD = fv.DRAFT_INSTRUCTION.format(brand="Brand", company="Company") + "\n" + fv.DRAFT_EXAMPLES_HEAD.format(brand="Brand")
_EXAMPLES = "WITH " + b.VECTORS_SQL + f""", texts AS (SELECT doc_id, text, {b.sql_squeeze('text')} AS reply FROM documents),
 ex AS (SELECT query_id, string_agg('- Customer: "' || text || '"' || chr(10) || '  Brand: "' || reply || '"', chr(10) ORDER BY rank) AS shown
   FROM ranked JOIN texts ON doc_id = corpus_id WHERE rank <= 3 GROUP BY 1)"""


@query(_EXAMPLES + f""" SELECT doc_id AS id, {quote(_DRAFT_HEAD)} || chr(10) || coalesce(shown || chr(10), '') || {quote(fv.DRAFT_TWEET_HEAD)} || chr(10) || '"' || text || '"'
  || chr(10) || {quote(fv.DRAFT_TAIL)} AS prompt FROM texts LEFT JOIN ex ON doc_id = query_id""")
def draft_prompt(spark, d):
    """A drafting prompt for every document, with its three nearest texts as examples where it has a vector."""
    queries, corpus = b.queries_and_corpus(spark, d)
    found = rt.top_k_similar(queries, corpus, 3, "vec_id", "vec_id")
    docs = load(spark, d, "documents").select("doc_id", F.col("text").alias(triage.TEXT))
    examples = found.join(docs, docs["doc_id"] == found["corpus_id"]).select(
        "query_id", F.col("rank").alias("example_no"), triage.TEXT, F.col(triage.TEXT).alias("brand_reply_clean")
    )
    routed = docs.withColumnRenamed("doc_id", triage.ID).withColumn("route", F.lit("draft"))
    return triage.draft_prompts(routed, examples, "Brand", "Company")


_CLASSIFY_HEAD = pm.classify_instruction("Brand") + '\n\nClassify this customer tweet:\n"'


@query(f"""SELECT doc_id AS id, {quote(_CLASSIFY_HEAD)} || text || '"' || {quote(chr(10) * 2 + fv.CLASSIFY_FORMAT)} AS prompt FROM documents""")
def classify_prompt(spark, d):
    return load(spark, d, "documents").select(
        F.col("doc_id").alias("id"), pm.classify_prompt(F.col("text"), "Brand").alias("prompt")
    )


@query("WITH " + b.PAIRS_SQL + f""" SELECT brand_reply_id AS id, {quote(fv.JUDGE_INSTRUCTION + chr(10) * 2 + 'CUSTOMER TWEET: "')} || customer_tweet
  || {quote('"' + chr(10) * 2 + 'AGENT REPLY: "')} || brand_reply || {quote('"' + chr(10) * 2 + fv.JUDGE_FORMAT)} AS prompt FROM pairs""")
def judge_prompt(spark, d):
    rows = b.pairs(spark, d).select(
        F.col("brand_reply_id").alias("customer_tweet_id"), F.col("customer_tweet").alias("tweet_text"),
        F.col("brand_reply").alias("drafted_reply"),
    )
    return assess.judge_prompts(rows)


def _judged(spark, d):
    return load(spark, d, "documents").select(
        F.col("doc_id").alias("customer_tweet_id"), F.col("text").alias("tweet_text"), F.col("text").alias("drafted_reply"))


def _judge_answers(spark, d):
    """First answers, and a second one, as bad as the first, for every fourth document."""
    first = b.judge_responses(spark, d)
    again = first.filter("id % 4 = 0").withColumn("attempt", F.lit(2))
    return first.unionByName(again)


@query(f"""SELECT doc_id AS id, {quote(fv.JUDGE_INSTRUCTION + chr(10) * 2 + 'CUSTOMER TWEET: "')} || text
  || {quote('"' + chr(10) * 2 + 'AGENT REPLY: "')} || text || {quote('"' + chr(10) * 2 + fv.JUDGE_FORMAT + fv.JUDGE_RETRY)} AS prompt
  FROM documents WHERE NOT ({_JUDGE_OK}) AND doc_id % 4 <> 0""")
def judge_retry_prompts(spark, d):
    return assess.judge_retry_prompts(_judged(spark, d), _judge_answers(spark, d))


@query(f"""SELECT doc_id AS customer_tweet_id, CASE WHEN doc_id % 4 = 0 THEN 'dead' ELSE 'retry' END AS reason
  FROM documents WHERE NOT ({_JUDGE_OK})""")
def judge_dead_letters(spark, d):
    return assess.judge_dead_letters(_judged(spark, d), _judge_answers(spark, d))


# ---- message to decision -----------------------------------------------------------------------------------

_CORPUS_INTENTS = tuple(b.INTENT_OF_LANG.values())
_TOP1_REPLY = b.sql_squeeze("coalesce(c.text, '')")
_TRIAGE = _ROUND + ", " + b.VECTORS_SQL + f""", routed AS (
   SELECT doc_id, text, intent, confidence, {sql_any('text', b.OVERRIDE_SQL)} AS fraud FROM documents JOIN rounds ON id = doc_id
   WHERE outcome = 'ok'),
 near AS (SELECT query_id, corpus_id, similarity, intent = list_extract([{', '.join(quote(i) for i in _CORPUS_INTENTS)}], corpus_label % 4 + 1) AS same
   FROM ranked JOIN routed ON doc_id = query_id WHERE rank <= 20 AND NOT fraud),
 matched AS (SELECT *, count_if(same) OVER (PARTITION BY query_id) AS m FROM near),
 top1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS k FROM matched
   WHERE m < 3 OR same) WHERE k = 1),
 drafted AS (SELECT r.*, trim(r.text) AS reply, {_TOP1_REPLY} AS top_reply, t.similarity FROM routed r LEFT JOIN top1 t ON t.query_id = r.doc_id
   LEFT JOIN documents c ON c.doc_id = t.corpus_id),
 named AS (SELECT *, {b.sql_overlap('reply', 'top_reply')} AS share, {b.sql_names('reply', greetings=fv.GREETINGS)} AS names FROM drafted),
 checked AS (SELECT doc_id, intent, confidence, fraud, CASE WHEN fraud THEN 0.0 ELSE coalesce(similarity, 0) END::DOUBLE AS sim,
   CASE WHEN fraud THEN {quote(fv.HOLDING_MESSAGE)} ELSE reply END AS drafted_reply, CASE WHEN fraud THEN [] ELSE list_concat(
     list_transform(names, lambda x: '"name used in draft: ''' || x || ''' (names are banned by policy)"'),
     CASE WHEN share >= 0.85 THEN ['''near-verbatim: ' || round_even(share * 100, 0)::INT || '% token overlap with top-1 retrieved reply'''] ELSE [] END) END AS msgs
   FROM named)"""
_TD, _TR = b.sql_decide("intent", "confidence", "fraud", "sim", "len(msgs) > 0", "'[' || array_to_string(msgs, ', ') || ']'",
                        ("account_access",), 0.75, 0.3)


def triage_corpus(spark, d):
    """The replies that examples are taken from."""
    _, corpus = b.queries_and_corpus(spark, d)
    docs = texts(spark, d, "documents").select("doc_id", "text")
    intents = F.array(*[F.lit(i) for i in _CORPUS_INTENTS])
    return corpus.join(docs, docs["doc_id"] == corpus["vec_id"], "left").select(
        "vec_id", "embedding", F.element_at(intents, (F.col("label") % 4 + 1).cast("int")).alias("predicted_intent"),
        F.col("text").alias(triage.TEXT), tx.squeeze(F.coalesce("text", F.lit(""))).alias("brand_reply_clean"),
    )


def _triaged(spark, d, drafts, chosen=None):
    """All documents decided, or those of ``chosen`` (doc_id, hard_case_category)."""
    queries, _ = b.queries_and_corpus(spark, d)
    docs = texts(spark, d, "documents").select("doc_id", "text")
    docs = docs if chosen is None else docs.join(chosen, "doc_id")
    rows = docs.join(queries, docs["doc_id"] == queries["vec_id"], "left").select(
        F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT), "embedding", *docs.columns[2:]
    )
    labels = triage.pseudo_labels(rows, b.responses(spark, d), patterns=b.OVERRIDE_PATTERNS)
    routed = staged(triage.route(rows, labels), "routed")
    examples = staged(triage.examples_for(routed, triage_corpus(spark, d), "vec_id"), "examples")
    return triage.triage(routed, examples, drafts, ("account_access",), b.ALLOWED_NAMES, 0.75, 0.3)


@query(_TRIAGE + f""" SELECT doc_id AS customer_tweet_id, intent AS predicted_intent, confidence AS predicted_confidence, drafted_reply,
  len(msgs)::INT AS n_flags, {_TD} AS escalation_decision, {_TR} AS escalation_reason FROM checked""")
def triage_decisions(spark, d):
    """Documents as messages: classified by the response table, routed, matched with examples, checked and decided. One
    without a vector goes on with no examples."""
    drafts = texts(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("reply"))
    return _triaged(spark, d, drafts).select(
        triage.ID, "predicted_intent", "predicted_confidence", "drafted_reply", F.size("validate_draft_flags").alias("n_flags"),
        "escalation_decision", "escalation_reason",
    )


def _some_drafts(spark, d):
    """A drafted reply for all documents but every fifth."""
    return texts(spark, d, "documents").filter("n_chars % 5 <> 0").select(F.col("doc_id").alias("id"), F.col("text").alias("reply"))


@query("SELECT count(*) AS n_messages, count(*) AS n_accounted, 0::BIGINT AS n_twice, 0::BIGINT AS n_lost FROM documents")
def triage_accounted(spark, d):
    """Every message is decided or listed as a dead letter, and none is both."""
    docs = texts(spark, d, "documents")
    decided = _triaged(spark, d, _some_drafts(spark, d)).select(triage.ID, F.lit(1).alias("decided"), F.lit(0).alias("dead"))
    dead = triage_dead_letters(spark, d).select(triage.ID, F.lit(0).alias("decided"), F.lit(1).alias("dead"))
    ends = decided.unionByName(dead).groupBy(triage.ID).agg(F.sum("decided").alias("decided"), F.sum("dead").alias("dead"))
    return docs.select(F.col("doc_id").alias(triage.ID)).join(ends, triage.ID, "left").agg(
        F.count("*").alias("n_messages"), F.count("decided").alias("n_accounted"),
        F.count_if(F.col("decided") + F.col("dead") > 1).alias("n_twice"), F.count_if(F.col("decided").isNull()).alias("n_lost"))


@query(_ROUND + f""", seen AS (SELECT doc_id, n_chars, outcome, {sql_any('text', b.OVERRIDE_SQL)} AS fraud FROM documents LEFT JOIN rounds ON id = doc_id)
 SELECT doc_id AS customer_tweet_id, CASE WHEN outcome = 'ok' THEN 'draft' ELSE 'classify' END AS stage,
  CASE WHEN outcome = 'ok' THEN 'missing' ELSE coalesce(outcome, 'missing') END AS reason
 FROM seen WHERE outcome IS DISTINCT FROM 'ok' OR (NOT fraud AND n_chars % 5 = 0)""")
def triage_dead_letters(spark, d):
    """Documents as messages that end without a decision; every fifth has no drafted reply."""
    docs = texts(spark, d, "documents")
    rows = docs.select(F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT))
    answers = b.responses(spark, d)
    labels = triage.pseudo_labels(rows, answers, patterns=b.OVERRIDE_PATTERNS)
    return triage.triage_dead_letters(rows, labels, answers, _some_drafts(spark, d))


# ---- scores -----------------------------------------------------------------------------------------------

_POINTS = ((0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max"))


@query("WITH " + b.VECTORS_SQL + ", best AS (SELECT similarity FROM ranked WHERE rank = 1), conf AS (SELECT (70 + n_chars % 29) / 100::DOUBLE AS c FROM documents) "
       + " UNION ALL ".join(
           f"SELECT '{s}' AS score, '{name}' AS point, quantile_cont({c}, {p})::DOUBLE AS value FROM {t}"
           for s, c, t in (("confidence", "c", "conf"), ("max_similarity", "similarity", "best")) for p, name in _POINTS
       ))
def score_profile(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    conf = load(spark, d, "documents").select(b.hundredths(70, F.col("n_chars"), 29).alias("confidence"))
    best = staged(rt.max_similarity(queries, corpus, "vec_id", "vec_id"), "similarity")
    both = conf.unionByName(best.select("max_similarity"), allowMissingColumns=True)
    return pf.score_profile(both, ["confidence", "max_similarity"])


@query("""WITH s AS (SELECT (70 + n_chars % 29) / 100::DOUBLE AS c, (60 + n_chars % 37) / 100::DOUBLE AS s FROM documents)
 SELECT 'min_confidence' AS threshold, round(quantile_cont(c, 0.25), 2)::DOUBLE AS value FROM s UNION ALL
 SELECT 'min_similarity', round(quantile_cont(s, 0.25), 2)::DOUBLE FROM s""")
def derive_thresholds(spark, d):
    n = F.col("n_chars")
    scores = load(spark, d, "documents").select(b.hundredths(70, n, 29).alias("c"), b.hundredths(60, n, 37).alias("s"))
    return pf.derive_thresholds(scores, "c", "s")


_LONG = " UNION ALL ".join(f"SELECT '{x}' AS dimension, {x}_score AS score FROM judge" for x in fv.JUDGE_DIMENSIONS)


@query("WITH " + b.JUDGE_SQL + f""", long AS ({_LONG}) SELECT dimension, count(score) AS n, avg(score) AS mean, stddev_samp(score) AS std FROM long GROUP BY 1""")
def dimension_summary(spark, d):
    return ev.dimension_summary(b.judge(spark, d))


@query("WITH " + b.HUMAN_SQL + f""" SELECT count(*) AS n_rows, count_if({' OR '.join(f'{x}_score IS NULL' for x in fv.JUDGE_DIMENSIONS)})::BIGINT AS n_missing FROM human""")
def missing_scores(spark, d):
    return ev.missing_scores(b.human(spark, d))


_PAIRED = " UNION ALL ".join(
    f"SELECT '{x}' AS dimension, h.{x}_score AS h, j.{x}_score AS l FROM human h JOIN judge j USING (customer_tweet_id) "
    f"WHERE h.{x}_score IS NOT NULL AND j.{x}_score IS NOT NULL"
    for x in fv.JUDGE_DIMENSIONS
)


_AGREEMENT = ("WITH " + b.HUMAN_SQL + ", " + b.JUDGE_SQL + f""", p AS ({_PAIRED}),
 r AS (SELECT *, rank() OVER (PARTITION BY dimension ORDER BY h) + (count(*) OVER (PARTITION BY dimension, h) - 1) / 2 AS rh,
   rank() OVER (PARTITION BY dimension ORDER BY l) + (count(*) OVER (PARTITION BY dimension, l) - 1) / 2 AS rl FROM p),
 s AS (SELECT dimension, count(*) AS n, corr(rh, rl) AS rho, avg((abs(h - l) <= 1)::INT)::DOUBLE AS adjacent_rate FROM r GROUP BY 1),
 k AS (SELECT *, n - 2 AS df, least(abs(rho), 1) AS a, greatest(1 - rho * rho, 0) AS c2 FROM s),
 j AS (SELECT dimension, df, a, c2, unnest(generate_series(1, CASE WHEN df % 2 = 0 THEN (df - 2) // 2 ELSE (df - 3) // 2 END)) AS j FROM k),
 t AS (SELECT dimension, exp(sum(ln(CASE WHEN df % 2 = 0 THEN (2 * j - 1) / (2 * j) ELSE 2 * j / (2 * j + 1) END)) OVER (PARTITION BY dimension ORDER BY j))
   * power(c2, j) AS term FROM j),
 q AS (SELECT dimension, 1 + sum(term) AS series FROM t GROUP BY 1),
 m AS (SELECT dimension, df, c2, unnest(generate_series(0, 4000)) AS m FROM k),
 u AS (SELECT dimension, power(c2, m) * exp(sum(CASE WHEN m = 0 THEN 0 ELSE ln((df - 1 + 2 * m) / (df + 2 * m)) END) OVER (PARTITION BY dimension ORDER BY m)) AS term FROM m),
 v AS (SELECT dimension, sum(term) AS tail FROM u GROUP BY 1),
 agreement AS (SELECT dimension, n, greatest(least(rho, 1), -1) AS spearman_rho, CASE WHEN a >= 1 THEN 0
   WHEN a > 0.1 THEN exp(df / 2 * ln(c2) + ln(a) - ln(df / 2) - lgamma(df / 2) - lgamma(0.5) + lgamma(df / 2 + 0.5)) * tail
   ELSE 1 - CASE WHEN df % 2 = 0 THEN a * series ELSE (asin(a) + a * sqrt(c2) * series) * 2 / pi() END END AS spearman_p, adjacent_rate
 FROM k JOIN q USING (dimension) JOIN v USING (dimension))""")


@query(_AGREEMENT + " SELECT * FROM agreement")
def judge_agreement(spark, d):
    scored = ev.score_pairs(b.human(spark, d), b.judge(spark, d), "customer_tweet_id")
    return ev.judge_agreement(scored)


@query(_AGREEMENT + """ SELECT dimension, '| ' || dimension || ' | ' || printf('%.3f', spearman_rho) || ' | ' || printf('%.3f', spearman_p)
  || ' | ' || printf('%.1f', adjacent_rate * 100) || '% |' AS line FROM agreement""")
def agreement_lines(spark, d):
    """The lines of the calibration report."""
    return ev.agreement_lines(judge_agreement(spark, d))


_STRATA = """g AS (SELECT hard_case_category, row_number() OVER (ORDER BY hard_case_category) - 1 AS i FROM golden GROUP BY 1),
 quota AS (SELECT hard_case_category, 45 // (SELECT count(*) FROM g) + CASE WHEN i < 45 % (SELECT count(*) FROM g) THEN 1 ELSE 0 END AS q FROM g),
 picked AS (SELECT t.* FROM (SELECT *, row_number() OVER (PARTITION BY hard_case_category ORDER BY md5('33:' || customer_tweet_id), customer_tweet_id) AS k
   FROM golden) t JOIN quota USING (hard_case_category) WHERE k <= q)"""


@query(_G + ", " + _STRATA + " SELECT customer_tweet_id, hard_case_category, tweet_text, drafted_reply, "
       + ", ".join(f"NULL::DOUBLE AS {x}_score" for x in fv.JUDGE_DIMENSIONS) + " FROM picked")
def scoring_template(spark, d):
    return assess.human_sample(b.golden(spark, d))


# ---- labels and metrics -------------------------------------------------------------------------------------


@query(_G + " SELECT predicted_intent, count(*) AS n FROM golden GROUP BY 1 ORDER BY n DESC, predicted_intent LIMIT 1")
def majority_label(spark, d):
    return ev.majority_label(b.golden(spark, d), "predicted_intent")


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def label_distribution(spark, d):
    return ev.label_distribution(load(spark, d, "documents"), "lang", "source")


def _confusion(true: str, pred: str) -> str:
    return f"""cells AS (SELECT {true} AS true_label, {pred} AS pred_label, count(*) AS n FROM golden GROUP BY ALL),
 l AS (SELECT true_label AS x FROM cells UNION SELECT pred_label FROM cells),
 confusion AS (SELECT a.x AS true_label, z.x AS pred_label, coalesce(n, 0) AS n FROM l a CROSS JOIN l z
   LEFT JOIN cells ON cells.true_label = a.x AND cells.pred_label = z.x)"""


@query(_G + ", " + _confusion("true_intent", "predicted_intent") + " SELECT * FROM confusion")
def confusion_matrix(spark, d):
    return ev.confusion_matrix(b.golden(spark, d), "true_intent", "predicted_intent")


@query(_G + """ SELECT true_escalation_decision AS true_label, count_if(escalation_decision = 'auto')::BIGINT AS auto,
  count_if(escalation_decision = 'escalate')::BIGINT AS escalate FROM golden GROUP BY 1""")
def confusion_wide(spark, d):
    return ev.confusion_wide(b.golden(spark, d), "true_escalation_decision", "escalation_decision", ["auto", "escalate"])


@query(_G + ", " + _confusion("simple_intent", "predicted_intent") + " SELECT * FROM confusion")
def classifier_disagreement(spark, d):
    return ev.confusion_matrix(b.golden(spark, d), "simple_intent", "predicted_intent")


@query(_G + " SELECT count(*) AS n, avg((true_intent = predicted_intent)::INT)::DOUBLE AS accuracy FROM golden")
def accuracy(spark, d):
    return ev.accuracy(b.golden(spark, d), "true_intent", "predicted_intent")


def _report(by: str, rows: str, true: str, pred: str, name: str = "report") -> str:
    key = f"{by}, " if by else ""
    using = f"{by}, label" if by else "label"
    return f"""{name}_t AS (SELECT {key}{true} AS label, count(*) AS support FROM {rows} GROUP BY ALL),
 {name}_p AS (SELECT {key}{pred} AS label, count(*) AS predicted, sum(({true} = {pred})::INT) AS tp FROM {rows} GROUP BY ALL),
 {name} AS (SELECT {key}label, CASE WHEN coalesce(predicted, 0) = 0 THEN 0 ELSE coalesce(tp, 0) / predicted END::DOUBLE AS precision,
   CASE WHEN coalesce(support, 0) = 0 THEN 0 ELSE coalesce(tp, 0) / support END::DOUBLE AS recall,
   (2 * coalesce(tp, 0) / (coalesce(support, 0) + coalesce(predicted, 0)))::DOUBLE AS f1,
   coalesce(support, 0)::BIGINT AS support, coalesce(tp, 0)::BIGINT AS hits
   FROM {name}_t FULL JOIN {name}_p USING ({using}))"""


@query(_G + ", " + _report("", "golden", "true_intent", "predicted_intent") + " SELECT * FROM report")
def classification_report(spark, d):
    return ev.classification_report(b.golden(spark, d), "true_intent", "predicted_intent")


@query(_G + ", " + _confusion("true_intent", "predicted_intent") + """ SELECT 'cell' AS section, true_label, pred_label, n::DOUBLE AS value FROM confusion
  UNION ALL SELECT 'accuracy', NULL, NULL, avg((true_intent = predicted_intent)::INT)::DOUBLE FROM golden""")
def training_report(spark, d):
    """Accuracy and labelled confusion matrix in one long table."""
    rows = b.golden(spark, d)
    cells = ev.confusion_matrix(rows, "true_intent", "predicted_intent").select(
        F.lit("cell").alias("section"), "true_label", "pred_label", F.col("n").cast("double").alias("value")
    )
    none = F.lit(None).cast("string")
    total = ev.accuracy(rows, "true_intent", "predicted_intent").select(
        F.lit("accuracy").alias("section"), none.alias("true_label"), none.alias("pred_label"), F.col("accuracy").alias("value")
    )
    return pf.union_all([cells, total])


_METHODS = _G + f""", majority AS (SELECT predicted_intent AS x FROM golden GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
 m AS (SELECT 'Trivial baseline' AS method, hard_case_category, true_intent, (SELECT x FROM majority) AS pred_intent,
     true_escalation_decision AS td, 'escalate' AS pd FROM golden
   UNION ALL SELECT 'Simple baseline', hard_case_category, true_intent, simple_intent, true_escalation_decision,
     CASE WHEN simple_intent IN {names_in(b.HIGH_RISK)} THEN 'escalate' ELSE 'auto' END FROM golden
   UNION ALL SELECT 'Full system', hard_case_category, true_intent, predicted_intent, true_escalation_decision, escalation_decision FROM golden)"""


def _six(by: str, rows: str) -> str:
    return (
        _report(by, rows, "true_intent", "pred_intent", "ri") + ", " + _report(by, rows, "td", "pd", "re") + f""",
 six AS (SELECT * FROM (SELECT {by}, avg((true_intent = pred_intent)::INT)::DOUBLE AS intent_accuracy, avg((td = pd)::INT)::DOUBLE AS escalation_accuracy
     FROM {rows} GROUP BY ALL)
   JOIN (SELECT {by}, avg(f1) AS intent_macro_f1 FROM ri GROUP BY ALL) USING ({by})
   LEFT JOIN (SELECT {by}, precision AS escalation_precision, recall AS escalation_recall, f1 AS escalation_f1 FROM re WHERE label = 'escalate') USING ({by}))"""
    )


def _methods(spark, d):
    rows = b.golden(spark, d)
    return ev.method_rows(rows, rows.select("predicted_intent"), "simple_intent", b.HIGH_RISK)


@query(_METHODS + ", " + _six("method", "m") + " SELECT * FROM six")
def compare_methods(spark, d):
    return ev.compare_methods(_methods(spark, d))


@query(_METHODS + ", ms AS (SELECT *, CASE WHEN hard_case_category = '' THEN 'stratified' ELSE 'hard' END AS subset FROM m), "
       + _six("method, subset", "ms") + " SELECT * FROM six")
def subset_metrics(spark, d):
    subset = F.when(F.col("hard_case_category") == "", "stratified").otherwise("hard")
    return ev.compare_methods(_methods(spark, d).withColumn("subset", subset), ["method", "subset"])


@query(_METHODS + ", " + _six("method", "m") + " SELECT method, '| ' || method || ' | ' || "
       + " || ' | ' || ".join(f"printf('%.3f', {m})" for m in ev.METRICS) + " || ' |' AS line FROM six")
def baseline_report_rows(spark, d):
    return ev.comparison_lines(ev.compare_methods(_methods(spark, d)))


# ---- failures -------------------------------------------------------------------------------------------------


@query(_GJ + """ SELECT customer_tweet_id, hard_case_category, true_intent, predicted_intent, escalation_decision, relevance_score,
  groundedness_score, tone_match_score, no_hallucinated_specifics_score, actionability_score FROM gj""")
def golden_with_scores(spark, d):
    return _scored(spark, d).select(
        "customer_tweet_id", "hard_case_category", "true_intent", "predicted_intent", "escalation_decision",
        *[f"{x}_score" for x in fv.JUDGE_DIMENSIONS],
    )


def _listing(name: str, cond: str, detail: str, order: str | None) -> str:
    tail = f" ORDER BY {order}" if order else ""
    return f"""SELECT '{name}' AS listing, (SELECT count(*) FROM gj WHERE {cond}) AS total, customer_tweet_id,
  substr(tweet_text, 1, 120) AS tweet, substr(drafted_reply, 1, 150) AS reply, {detail} AS detail FROM (SELECT * FROM gj WHERE {cond}{tail})"""


def _detail(*cols: str) -> str:
    return " || ' | ' || ".join(f"'{c}=' || coalesce({c}::VARCHAR, 'nan')" for c in cols)


_MIS = "true_intent IS DISTINCT FROM predicted_intent"
_MISSED = "true_escalation_decision = 'escalate' AND escalation_decision = 'auto'"
_LISTS = {
    "misclassified_top": _listing("misclassified", _MIS, _detail("true_intent", "predicted_intent", "predicted_confidence"),
                                  "predicted_confidence DESC, customer_tweet_id LIMIT 5"),
    "missed_escalations": _listing("missed_escalations", _MISSED,
                                   _detail("true_escalation_decision", "escalation_decision", "escalation_reason"), None),
    "over_escalations": _listing("over_escalations", "true_escalation_decision = 'auto' AND escalation_decision = 'escalate'",
                                 _detail("escalation_reason"), "customer_tweet_id LIMIT 2"),
    "hard_case_failures": _listing(
        "hard_case_failures", f"hard_case_category <> '' AND ({_MIS} OR true_escalation_decision IS DISTINCT FROM escalation_decision)",
        _detail("hard_case_category", "true_intent", "predicted_intent", "true_escalation_decision", "escalation_decision"),
        "customer_tweet_id LIMIT 5"),
    "low_grounding": _listing("low_grounding", "coalesce(groundedness_score <= 2, false) OR coalesce(no_hallucinated_specifics_score <= 2, false)",
                              _detail("groundedness_score", "no_hallucinated_specifics_score"), "customer_tweet_id LIMIT 5"),
    "flagged_drafts": _listing("flagged_drafts", "len(names) > 0",
                               "'flag_kinds=' || array_to_string(list_transform(names, lambda x: 'name'), ',')", "customer_tweet_id LIMIT 5"),
}


@query(_GJ + " " + _LISTS["misclassified_top"])
def misclassified_top(spark, d):
    return fl.named_listing(_scored(spark, d), "misclassified")


@query(_GJ + " " + _LISTS["missed_escalations"])
def missed_escalations(spark, d):
    return fl.named_listing(_scored(spark, d), "missed_escalations")


@query(_GJ + " " + _LISTS["over_escalations"])
def over_escalations(spark, d):
    return fl.named_listing(_scored(spark, d), "over_escalations")


@query(_GJ + " " + _LISTS["hard_case_failures"])
def hard_case_failures(spark, d):
    return fl.named_listing(_scored(spark, d), "hard_case_failures")


@query(_GJ + " " + _LISTS["low_grounding"])
def low_grounding(spark, d):
    return fl.named_listing(_scored(spark, d), "low_grounding")


@query(_GJ + " " + _LISTS["flagged_drafts"])
def flagged_drafts(spark, d):
    return fl.named_listing(_scored(spark, d), "flagged_drafts")


@query(_GJ + " " + " UNION ALL ".join(f"({s})" for s in _LISTS.values()))
def failure_candidates(spark, d):
    return fl.failure_candidates(_scored(spark, d))


@query(_GJ + " " + _listing("hard_rows", "hard_case_category <> ''", _detail("hard_case_category", "true_intent"),
                            "hard_case_category, customer_tweet_id LIMIT 7"))
def failure_listing(spark, d):
    """The listing form itself on another condition: total, first rows, cut texts."""
    cond = F.coalesce(F.col("hard_case_category"), F.lit("")) != ""
    return fl.listing(_scored(spark, d), "hard_rows", cond, ["hard_case_category", "true_intent"], 7, ["hard_case_category"])


@query(_G + f" SELECT customer_tweet_id, true_intent, predicted_intent FROM golden WHERE {_MIS} AND {_MISSED}")
def cascade_failures(spark, d):
    return fl.cascade_failures(staged(b.golden(spark, d), "golden"))
