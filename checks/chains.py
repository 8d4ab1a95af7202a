"""Queries on stored tables (typed re-read, batches, feature cache) and on whole chains."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import assess, ingest, search
from checks import base as b
from checks.base import load, texts
from spark_triage import fixed_values as fv
from spark_triage.functions import prompts as pm
from spark_triage.operators import models as md
from spark_triage.operators import retrieval as rt
from spark_triage.plans import discover, learn, triage
from spark_triage.session import fits, shared_folder, staged
from spark_triage.sources import batches, feature_cache as fc, typed

QUERIES, SQL = {}, {}
SLOTS = 16


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# ---- stored tables --------------------------------------------------------------------------------------

DECLARED = T.StructType([
    T.StructField("doc_id", T.LongType(), False), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("source", T.StringType())])


@query("""SELECT doc_id, lang, CASE WHEN doc_id % 10 IN (3, 7) THEN NULL ELSE n_chars END AS n_chars, NULL::VARCHAR AS source,
  CASE WHEN doc_id % 10 IN (3, 7) THEN 'not a bigint' END AS reason,
  CASE doc_id % 10 WHEN 3 THEN 'n/a' WHEN 7 THEN n_chars || '.5' END AS value, 2::BIGINT AS n_drift FROM documents""")
def typed_reread(spark, d):
    """The documents written as CSV with a column too many, one too few and two kinds of bad cells, read as declared."""
    docs = load(spark, d, "documents")
    kind, n = F.col("doc_id") % 10, F.col("n_chars").cast("string")
    cell = F.when(kind == 3, "n/a").when(kind == 7, F.concat(n, F.lit(".5"))).otherwise(n)
    path = folder(spark, "reread")
    docs.select("lang", cell.alias("n_chars"), "doc_id", F.lit("x").alias("note")).write.csv(path, header=True, escape='"')
    read = typed.read_typed_csv(spark, path, DECLARED, "doc_id")
    bad = read.rejects.select(F.col("key").cast("long").alias("doc_id"), "reason", "value")
    drift = read.drift.agg(F.count("*").alias("n")).scalar()
    return read.rows.join(bad, "doc_id", "left").withColumn("n_drift", drift)


@query("""SELECT 'b' || doc_id % 4 AS batch, count(*) AS rows, count(*) AS found, 1 AS n_added FROM documents GROUP BY 1""")
def resume_commit(spark, d):
    """The documents appended in four batches, each of them twice, after a first run of one that was lost half-way."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars", (F.col("doc_id") % 4).alias("part"))
    path = folder(spark, "batches")
    docs.filter("part = 1 and doc_id % 3 = 0").drop("part").write.parquet(f"{path}/data/batch=b1/attempt=lost")
    added = {f"b{i}": 0 for i in range(4)}
    for _ in range(2):
        for i in range(4):
            added[f"b{i}"] += batches.append_once(docs.filter(F.col("part") == i).drop("part"), path, f"b{i}")
    times = F.create_map(*[F.lit(x) for kv in added.items() for x in kv])
    return batches.check_batches(spark, path, docs.drop("part").schema).withColumn("n_added", F.element_at(times, F.col("batch")))


_SLOTS = f"""tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{b.W}]{{2,}}')) AS term FROM documents),
 tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
 idf AS (SELECT term, ln((1 + (SELECT count(DISTINCT doc_id) FROM documents)::DOUBLE) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term),
 hashed AS (SELECT term, idf, ('0x' || substr(md5(term), 1, 8))::BIGINT % {SLOTS} AS slot,
   CASE WHEN ('0x' || substr(md5(term), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sign FROM idf),
 sums AS (SELECT doc_id, slot, sum(tf * idf * sign) AS w FROM tf JOIN hashed USING (term) GROUP BY ALL),
 unit AS (SELECT doc_id, slot, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM sums)"""


def _weights(spark, d):
    return staged(fc.term_weights(texts(spark, d, "documents"), "doc_id", "text"), "term-weights")


@query(f"""WITH {_SLOTS} SELECT doc_id, s AS slot, coalesce(w, 0.0)::DOUBLE AS value
  FROM documents CROSS JOIN (SELECT unnest(range({SLOTS}))::INT AS s) LEFT JOIN unit USING (doc_id) WHERE s = slot
  UNION ALL SELECT doc_id, s, 0.0 FROM documents CROSS JOIN (SELECT unnest(range({SLOTS}))::INT AS s)
  WHERE NOT EXISTS (SELECT 1 FROM unit u WHERE u.doc_id = documents.doc_id AND u.slot = s)""")
def hashed_vectors(spark, d):
    rows = fc.hashed_vectors(texts(spark, d, "documents"), "doc_id", "text", _weights(spark, d), SLOTS)
    return rows.select("doc_id", F.posexplode("embedding").alias("slot", "value"))


@query("""SELECT d.doc_id, CASE WHEN l.quality = 1 AND d.lang <> 'fr' THEN 1 ELSE 2 END::BIGINT AS version, true AS is_current
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def embedding_cache_merge(spark, d):
    """A cache of the good documents, its French texts stale, merged with all documents, and merged again: the second
    time nothing is encoded. Every vector is that of the document's text as it is now."""
    docs = texts(spark, d, "documents").select("doc_id", "text", "lang")
    weights = _weights(spark, d)
    encode = lambda rows: fc.hashed_vectors(rows, "doc_id", "text", weights, SLOTS)
    good = staged(load(spark, d, "labels").filter("quality = 1").select("doc_id"), "good-labels")
    good = F.broadcast(good) if fits(good, "doc_id", fc.SENT_BYTES) else good  # else the texts move
    old = staged(docs.join(good, "doc_id").withColumn(
        "text", F.when(F.col("lang") == "fr", F.concat("text", F.lit("?"))).otherwise(F.col("text"))), "old-texts", "zstd")
    cache = staged(fc.merge_cache(fc.empty_cache(docs, "doc_id"), old, "doc_id", "text", "m1", 1, encode), "cache")
    cache = staged(fc.merge_cache(cache, docs, "doc_id", "text", "m1", 2, encode), "cache")
    again = fc.merge_cache(cache, docs, "doc_id", "text", "m1", 3, encode)
    now = encode(docs).withColumnRenamed("embedding", "now")
    far = F.aggregate(F.zip_with("embedding", "now", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda a, x: a + x)
    return again.join(now, "doc_id").select("doc_id", "version", (far < 1e-9).alias("is_current"))


_PREFIX = fv.QUERY_PREFIX.replace("'", "''")


@query(f"""WITH {_SLOTS},
 q_tok AS (SELECT item_id, unnest(regexp_extract_all(lower('{_PREFIX}' || text), '[{b.W}]{{2,}}')) AS term FROM benchmark),
 q_tf AS (SELECT item_id, term, count(*) AS tf FROM q_tok GROUP BY ALL),
 q_w AS (SELECT item_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {SLOTS} AS slot, sum(tf * coalesce(idf, ln(1 + (SELECT count(DISTINCT doc_id) FROM documents)::DOUBLE) + 1)
   * CASE WHEN ('0x' || substr(md5(term), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS w FROM q_tf LEFT JOIN idf USING (term) GROUP BY ALL),
 q AS (SELECT item_id, slot, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM q_w),
 sims AS (SELECT item_id, doc_id, round(sum(q.w * unit.w), 9) AS similarity FROM q JOIN unit USING (slot) GROUP BY ALL),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM sims)
 SELECT item_id, doc_id, round(similarity, 6) AS similarity FROM ranked WHERE rank = 1""")
def encoded_retrieval(spark, d):
    """The nearest document of every benchmark item, the items encoded with the query prefix, the documents without."""
    weights = _weights(spark, d)
    items = load(spark, d, "benchmark").select("item_id", pm.query_text(F.col("text")).alias("text"))
    queries = staged(fc.hashed_vectors(items, "item_id", "text", weights, SLOTS), "encoded-items")
    corpus = staged(fc.hashed_vectors(texts(spark, d, "documents"), "doc_id", "text", weights, SLOTS), "encoded-documents")
    return rt.top_k_similar(queries, corpus, 1, "item_id", "doc_id").select(
        F.col("query_id").alias("item_id"), F.col("corpus_id").alias("doc_id"), F.round("similarity", 6).alias("similarity"))


# ---- discovery --------------------------------------------------------------------------------------------


@query(search.SQL["cluster_terms"].replace(" SELECT * FROM r WHERE rank <= 15", """, n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
 shown AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id)::INT AS k FROM documents),
 lines AS (SELECT source, 0 AS line_no, '## Cluster ' || substr(source, 4) || ' (n=' || n || ')' AS line FROM n
   UNION ALL SELECT source, 1, '**Top TF-IDF terms:** ' || coalesce((SELECT string_agg(term, ', ' ORDER BY rank) FROM r WHERE r.source = n.source AND rank <= 15), '') FROM n
   UNION ALL SELECT source, 2, '**Example tweets:**' FROM n
   UNION ALL SELECT source, k + 2, '- ' || text FROM shown WHERE k <= 8)
 SELECT substr(source, 4)::INT AS cluster, line_no::INT AS line_no, line FROM lines WHERE source IS NOT NULL"""))
def cluster_report(spark, d):
    """The lines of the discovery report, sources standing for clusters."""
    docs = texts(spark, d, "documents").filter("source is not null").withColumn("cluster", F.substring("source", 4, 9).cast("int"))
    return discover.cluster_report(docs, "cluster", "doc_id", "text", search.STOP_WORDS)


@query("SELECT unnest([5, 6, 7, 8, 9, 10])::INT AS k, (SELECT count(*) FROM embeddings) AS n_labelled, 11::BIGINT AS n_head_lines")
def discovery_chain(spark, d):
    """The whole discovery of intents over the vectors: sample, scan of k, labels, report."""
    docs = texts(spark, d, "documents").select("doc_id", "text")
    vectors = b.vectors(spark, d)
    rows = vectors.join(docs, docs["doc_id"] == vectors["vec_id"], "left").select("vec_id", "embedding", F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    out = discover.discover(rows, "vec_id", "text", 8, sample=n, stop_words=search.STOP_WORDS, starts=2)
    heads = out["report"].filter("cluster = 0").agg(F.count("*").alias("n")).scalar()
    labelled = out["labelled"].agg(F.count("cluster").alias("n")).scalar()
    return out["scan"].select("k", labelled.alias("n_labelled"), heads.alias("n_head_lines"))


# ---- models -------------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT 'q' || quality || 't' || toxic AS label FROM documents JOIN labels USING (doc_id))
 SELECT label, count(*) AS n, true AS at_optimum, 0::BIGINT AS n_changed, (SELECT count(*) FROM documents) AS n_scored FROM l GROUP BY 1""")
def classifier_optimality(spark, d):
    """The gradient of the fitted model is under a fiftieth of what it is without a model, and the model read back labels
    all documents alike."""
    rows = search._labelled(spark, d)
    model = md.train_classifier(rows, "text", "intent", stop_words=search.STOP_WORDS)
    path = folder(spark, "model")
    model.write().save(path)
    docs = texts(spark, d, "documents").select("doc_id", "text")
    one = md.classify(docs, model).select("doc_id", "predicted_intent")
    two = md.classify(docs, PipelineModel.load(path)).select("doc_id", F.col("predicted_intent").alias("again"))
    same = one.join(two, "doc_id").agg(F.struct(
        F.count("*").alias("n"), F.count_if(~F.col("predicted_intent").eqNullSafe(F.col("again"))).alias("changed")).alias("x")).scalar()
    slopes = staged(md.gradients(rows, model, "text", "intent"), "gradients")
    size = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)))
    small = slopes.agg((size("gradient") < 0.02 * size("gradient_at_zero")).alias("x")).scalar()
    return slopes.select("label", "n", small.alias("at_optimum"), same["changed"].alias("n_changed"), same["n"].alias("n_scored"))


_LABELLED = assess._ROUND + """, drawn AS (SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 700),
 lab AS (SELECT doc_id, intent, confidence FROM drawn JOIN rounds ON id = doc_id WHERE outcome = 'ok')"""


def _learned(spark, d):
    working = texts(spark, d, "documents").select(F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT))
    corpus = b.clean_pairs(spark, d).select("brand_reply_id", F.col("customer_tweet_clean").alias(triage.TEXT))
    return learn.train_and_backfill(
        working, b.responses(spark, d), corpus, folder(spark, "intents"), patterns=b.OVERRIDE_PATTERNS, stop_words=search.STOP_WORDS)


@query(_LABELLED + """ SELECT intent AS label, count(*) AS support, true AS in_range FROM lab GROUP BY 1""")
def training_report(spark, d):
    """Pseudo-labels of the seeded sample, a model fitted to them, saved and read back, and its report."""
    report = _learned(spark, d)["report"].filter("support > 0")
    inside = F.col("precision").between(0, 1) & F.col("recall").between(0, 1)
    return report.select("label", F.col("support").cast("long").alias("support"), inside.alias("in_range"))


@query(_LABELLED + ", " + b.PAIRS_SQL.split("WITH ")[-1] + """ SELECT (SELECT count(*) FROM lab) AS n_labels, count(*) AS n_pairs, 0::BIGINT AS n_without_intent,
   0::BIGINT AS n_unknown_intent FROM pairs""")
def corpus_with_intents(spark, d):
    """The corpus after the chain: every pair has an intent, and one that the labels hold."""
    out = _learned(spark, d)
    known = F.broadcast(out["labels"].select("predicted_intent").distinct().withColumn("known", F.lit(True)))
    return out["corpus"].join(known, "predicted_intent", "left").agg(
        F.count("*").alias("n_pairs"), F.count_if(F.col("predicted_intent").isNull()).alias("n_without_intent"),
        F.count_if(F.col("known").isNull()).alias("n_unknown_intent"),
    ).withColumn("n_labels", out["labels"].agg(F.count("*").alias("n")).scalar())


@query(assess._ROUND + f""", drawn AS (SELECT doc_id, text FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 20)
 SELECT count(*) AS n_rows, count_if(outcome = 'ok')::BIGINT AS n_ok, count_if(attempts = 2 OR outcome = 'retry')::BIGINT AS n_retried,
   count_if(outcome = 'dead')::BIGINT AS n_failed, count_if({b.sql_any('text', b.OVERRIDE_SQL)})::BIGINT AS n_overridden
 FROM drawn LEFT JOIN rounds ON id = doc_id""")
def pilot_run(spark, d):
    """Twenty messages classified before the whole run, and what became of them."""
    working = texts(spark, d, "documents").select(F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT))
    return learn.pilot_run(working, b.responses(spark, d), patterns=b.OVERRIDE_PATTERNS)["counts"]


@query(assess._METHODS + ", " + assess._six("method", "m") + " SELECT * FROM six WHERE method <> 'Simple baseline'")
def baselines_with_model(spark, d):
    """The comparison of methods with a fitted, stored and reloaded classifier as the simple one; its own row has no SQL."""
    golden = b.golden(spark, d)
    told = golden.select(F.col("tweet_text").alias(triage.TEXT), "true_intent")
    model = learn.train_and_reload(told.withColumnRenamed("true_intent", "predicted_intent"), folder(spark, "simple"), stop_words=search.STOP_WORDS)
    out = learn.compare_with_model(golden, golden.select("predicted_intent"), model, high_risk=b.HIGH_RISK)
    return out["metrics"].filter("method <> 'Simple baseline'")


@query(_LABELLED + ", " + b.CLEAN_SQL.split("WITH ")[-1] + """ SELECT brand_reply_id, vec_id IS NOT NULL AS has_vector, true AS has_known_intent FROM clean_pairs
  LEFT JOIN embeddings ON vec_id = brand_reply_id >> 32 WHERE NOT has_link AND length(brand_reply_clean) >= 40""")
def retrieval_corpus(spark, d):
    """The retrieval corpus: substantive pairs with their vectors and the intents of the chain's model."""
    working = texts(spark, d, "documents").select(F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT))
    labels = staged(learn.label_sample(working, b.responses(spark, d), patterns=b.OVERRIDE_PATTERNS), "pseudo-labels")
    model = learn.train_and_reload(labels, folder(spark, "intents"), True, search.STOP_WORDS)
    pairs = b.clean_pairs(spark, d).withColumn("vec_id", F.shiftright("brand_reply_id", 32))
    known = F.broadcast(labels.select("predicted_intent").distinct().withColumn("known", F.lit(True)))  # the taxonomy
    return learn.build_retrieval(pairs, b.vectors(spark, d), model, "vec_id").join(known, "predicted_intent", "left").select(
        "brand_reply_id", F.col("embedding").isNotNull().alias("has_vector"), F.col("known").isNotNull().alias("has_known_intent"))


# ---- trials --------------------------------------------------------------------------------------------------

_PICKED = ", " + ingest._strata("checked", "intent", "doc_id", "15", 13)


def _trial(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    docs = texts(spark, d, "documents").select("doc_id", "text")
    rows = docs.select(F.col("doc_id").alias(triage.ID), F.col("text").alias(triage.TEXT))
    labels = triage.pseudo_labels(rows, b.responses(spark, d), patterns=b.OVERRIDE_PATTERNS)
    answer = lambda prompts: prompts.select("id").join(docs, docs["doc_id"] == F.col("id")).select("id", F.col("text").alias("reply"))
    return learn.draft_trial(
        labels, queries.select(F.col("vec_id").alias(triage.ID), "embedding"), assess.triage_corpus(spark, d), "vec_id", answer,
        high_risk=("account_access",), allowlist=b.ALLOWED_NAMES, min_confidence=0.75, min_similarity=0.3)


@query(assess._TRIAGE + _PICKED + f""" SELECT doc_id AS customer_tweet_id, intent AS predicted_intent, drafted_reply, len(msgs)::INT AS n_flags,
  {assess._TD} AS escalation_decision, false AS forced FROM picked""")
def draft_trial(spark, d):
    """A drafting trial of fifteen messages, the same number of every intent."""
    return _trial(spark, d)["rows"].select(
        triage.ID, "predicted_intent", "drafted_reply", F.size("validate_draft_flags").alias("n_flags"), "escalation_decision", "forced")


@query(assess._TRIAGE + _PICKED + """ SELECT count(*) AS n_checked, count_if(len(list_filter(msgs, lambda x: starts_with(x, '''near-verbatim'))) > 0)::BIGINT AS n_flagged,
  avg((len(list_filter(msgs, lambda x: starts_with(x, '''near-verbatim'))) > 0)::INT)::DOUBLE AS rate FROM picked WHERE NOT fraud""")
def draft_trial_rate(spark, d):
    return _trial(spark, d)["rate"]


@query(f"""WITH s AS ({search.SQL['select_stress_set']}), t AS ({assess.SQL['triage_decisions']})
 SELECT customer_tweet_id, hard_case_category, predicted_intent, n_flags, escalation_decision, escalation_reason
 FROM s JOIN t ON s.doc_id = t.customer_tweet_id""")
def stress_set_decisions(spark, d):
    """The selected stress set through the whole triage."""
    chosen = search.select_stress_set(spark, d).select("doc_id", "hard_case_category")
    drafts = texts(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("reply"))
    return assess._triaged(spark, d, drafts, staged(chosen, "stress-set")).select(
        triage.ID, "hard_case_category", "predicted_intent", F.size("validate_draft_flags").alias("n_flags"),
        "escalation_decision", "escalation_reason")
