"""Queries on vectors, retrieval, the evaluation set, features and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import base as b
from checks.base import load, sql_any, texts
from spark_triage.operators import features as ft
from spark_triage.operators import kmeans as km
from spark_triage.operators import models as md
from spark_triage.operators import retrieval as rt
from spark_triage.operators import sampling as sm
from spark_triage.operators import stress_set as ss
from spark_triage.session import staged

QUERIES, SQL = {}, {}
STOP_WORDS = ("the", "and", "of", "to", "in", "is", "it", "that", "for", "was", "on", "are", "as", "with", "this", "url")
PLAN = ss.StressPlan(stratified=160, per_category=10, hard_total=40, low_pool=50, high_similarity=0.38)


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


# ---- vectors ------------------------------------------------------------------------------------------


@query("""SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm,
  embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS first,
  embedding[-1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS last FROM embeddings""")
def normalize_vectors(spark, d):
    unit = b.vectors(spark, d).withColumn("unit", rt.normalize(F.col("embedding")))
    return unit.select(
        "vec_id", F.sqrt(rt.dot(F.col("embedding"), F.col("embedding"))).alias("norm"),
        F.element_at("unit", 1).alias("first"), F.element_at("unit", -1).alias("last"),
    )


@query("""SELECT doc_id, 'm1' AS model_version FROM documents d WHERE NOT EXISTS
  (SELECT 1 FROM labels l JOIN documents x USING (doc_id) WHERE l.doc_id = d.doc_id AND l.quality = 1 AND x.lang <> 'fr')""")
def embedding_cache_delta(spark, d):
    """Documents whose vector must be (re)computed: the cache holds the good ones, its French texts being stale."""
    docs = load(spark, d, "documents").select("doc_id", "text", "lang")
    cached = docs.join(load(spark, d, "labels").filter("quality = 1"), "doc_id").select(
        "doc_id", F.lit("m1").alias("model_version"),
        F.xxhash64(F.when(F.col("lang") == "fr", F.concat("text", F.lit("?"))).otherwise(F.col("text"))).alias("text_hash"),
    )
    return rt.vectors_to_compute(docs, cached, "doc_id", "text", "m1").select("doc_id", "model_version")


@query("WITH " + b.VECTORS_SQL + " SELECT query_id, corpus_id, similarity, rank::INT AS rank FROM ranked WHERE rank <= 20")
def topk_similarity(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    return rt.top_k_similar(queries, corpus, 20, "vec_id", "vec_id")


@query("WITH " + b.VECTORS_SQL + " SELECT query_id, similarity AS max_similarity FROM ranked WHERE rank = 1")
def max_similarity(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    return rt.max_similarity(queries, corpus, "vec_id", "vec_id")


@query("WITH " + b.VECTORS_SQL + """, t AS (SELECT *, count_if(corpus_label = query_label) OVER (PARTITION BY query_id) AS m FROM ranked WHERE rank <= 20),
 k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS example_no FROM t
       WHERE m < 3 OR corpus_label = query_label)
 SELECT query_id, corpus_id, similarity, m < 3 AS fallback, example_no::INT AS example_no FROM k WHERE example_no <= 3""")
def retrieve_examples(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    return rt.retrieve_examples(queries, corpus, "vec_id", "vec_id", "label", "label").select(
        "query_id", "corpus_id", "similarity", "fallback", "example_no"
    )


@query("WITH " + b.CLEAN_SQL + """ SELECT brand_reply_id, brand_reply_clean, len(embedding)::INT AS dims FROM clean_pairs
  LEFT JOIN embeddings ON vec_id = brand_reply_id >> 32 WHERE NOT has_link AND length(brand_reply_clean) >= 40""")
def build_corpus(spark, d):
    pairs = b.clean_pairs(spark, d).withColumn("vec_id", F.shiftright("brand_reply_id", 32))
    return rt.build_corpus(pairs, b.vectors(spark, d), "vec_id").select(
        "brand_reply_id", "brand_reply_clean", F.size("embedding").alias("dims")
    )


# ---- evaluation set -----------------------------------------------------------------------------------

_POOL = "WITH " + b.VECTORS_SQL + f""", pool AS (SELECT d.doc_id, coalesce(e.label, -1) AS label, r.similarity AS max_similarity,
  {sql_any('d.text', b.OVERRIDE_SQL)} AS fraud_override, {sql_any('d.text', b.VOCAB_SQL)} AS pay_for_match
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN ranked r ON r.query_id = d.doc_id AND r.rank = 1)"""


def _pool(spark, d):
    queries, corpus = b.queries_and_corpus(spark, d)
    best = rt.max_similarity(queries, corpus, "vec_id", "vec_id").withColumnRenamed("query_id", "doc_id")
    labels = corpus.select(F.col("vec_id").alias("doc_id"), "label")
    rows = load(spark, d, "documents").join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(-1)))
    return ss.sampling_pool(rows, best, "doc_id", "text", b.OVERRIDE_PATTERNS, b.VOCAB_PATTERNS).select(
        "doc_id", "label", "max_similarity", "fraud_override", "pay_for_match"
    )


@query(_POOL + " SELECT * FROM pool")
def sampling_pool(spark, d):
    return _pool(spark, d)


@query(_POOL + " SELECT doc_id, max_similarity FROM pool ORDER BY max_similarity, doc_id LIMIT 50")
def low_similarity_pool(spark, d):
    return sm.lowest(_pool(spark, d), "max_similarity", "doc_id", 50).select("doc_id", "max_similarity")


def _take(no: int, source: str, cond: str, label: str, n: str = "10") -> str:
    before = "".join(f" AND doc_id NOT IN (SELECT doc_id FROM t{i})" for i in range(1, no))
    return f""", t{no} AS (SELECT *, '{label}' AS hard_case_category FROM {source} WHERE {cond}{before}
      ORDER BY md5('22:' || doc_id), doc_id LIMIT {n})"""


_TAKEN = " + ".join(f"(SELECT count(*) FROM t{i})" for i in range(1, 5))


@query(_POOL + """, g AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM pool GROUP BY 1),
 quota AS (SELECT label, 160 // (SELECT count(*) FROM g) + CASE WHEN i < 160 % (SELECT count(*) FROM g) THEN 1 ELSE 0 END AS q FROM g),
 strat AS (SELECT p.* EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('21:' || doc_id), doc_id) AS k FROM pool) p
           JOIN quota USING (label) WHERE k <= q),
 rest AS (SELECT * FROM pool WHERE doc_id NOT IN (SELECT doc_id FROM strat)),
 low AS (SELECT * FROM rest ORDER BY max_similarity, doc_id LIMIT 50)"""
       + _take(1, "rest", "fraud_override", "fraud_keyword") + _take(2, "rest", "max_similarity > 0.38", "near_verbatim_stress")
       + _take(3, "rest", "pay_for_match", "pay_for_vocab_overlap") + _take(4, "low", "true", "low_retrieval_similarity")
       + f", wide AS (SELECT * FROM rest ORDER BY max_similarity, doc_id LIMIT (SELECT 50 + greatest(40 - ({_TAKEN}), 0)))"
       + _take(5, "wide", "true", "low_retrieval_similarity_backfill", f"(SELECT greatest(40 - ({_TAKEN}), 0))")
       + """ SELECT *, '' AS hard_case_category FROM strat UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2
 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t4 UNION ALL SELECT * FROM t5""")
def select_stress_set(spark, d):
    return ss.select_stress_set(staged(_pool(spark, d), "pool"), "doc_id", "label", PLAN)


# ---- clusters and terms -------------------------------------------------------------------------------


@query()
def kmeans_fit(spark, d):
    rows = b.vectors(spark, d)
    model = md.best_kmeans(rows, 8, starts=10)
    return md.assign_clusters(rows, model).select("vec_id", "cluster")


@query("SELECT count(*) AS n_rows, least(count(DISTINCT embedding), 8) AS n_clusters, 0::BIGINT AS n_elsewhere FROM embeddings")
def kmeans_invariants(spark, d):
    """What holds for any settled fit: every row has a cluster, no cluster is empty, and no row is nearer to the mean of
    another cluster than to its own."""
    rows = b.vectors(spark, d)
    model = md.best_kmeans(rows, 8, starts=2)
    means = [[float(x) for x in c] for c in model.clusterCenters()]
    away = lambda c: F.aggregate(
        F.zip_with(F.transform("embedding", lambda x: x.cast("double")), F.array(*map(F.lit, c)), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0), lambda a, x: a + x)
    far = F.array(*[away(c) for c in means])
    own = F.element_at(far, F.col("cluster") + 1)
    return md.assign_clusters(rows, model).agg(
        F.count("*").alias("n_rows"), F.count_distinct("cluster").alias("n_clusters"),
        F.count_if(own > F.array_min(far) + 1e-9).alias("n_elsewhere"))


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 dist AS (SELECT a.vec_id, a.label AS own, c.label AS other, list_distance(a.e, c.e) AS dist FROM v a, v c),
 s AS (SELECT vec_id, own, other, sum(dist) AS total, count(*) AS n FROM dist GROUP BY ALL),
 ab AS (SELECT vec_id, own, max(CASE WHEN own = other THEN total / (n - 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b FROM s GROUP BY ALL)
 SELECT vec_id, own AS label, (b - a) / greatest(a, b) AS silhouette FROM ab""")
def silhouette(spark, d):
    return md.silhouette(b.vectors(spark, d), "vec_id", "label")


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 dist AS (SELECT a.vec_id, a.label AS own, c.label AS other, list_sum(list_transform(list_zip(a.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
   FROM v a, v c),
 s AS (SELECT vec_id, own, other, sum(d) AS total, count(*) AS n FROM dist GROUP BY ALL),
 ab AS (SELECT vec_id, own, max(CASE WHEN own = other THEN total / (n - 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b FROM s GROUP BY ALL)
 SELECT vec_id, own AS label, (b - a) / greatest(a, b) AS silhouette FROM ab""")
def silhouette_linear(spark, d):
    return km.silhouette_linear(b.vectors(spark, d), "vec_id", "label")


@query("""SELECT k, (SELECT count(*) FROM embeddings) AS n_rows, least((SELECT count(DISTINCT embedding) FROM embeddings), k) AS n_clusters,
   0::BIGINT AS n_elsewhere, true AS in_range, true AS best_of_starts FROM (SELECT unnest([5, 6, 7, 8, 9, 10])::INT AS k)""")
def scan_k(spark, d):
    """What holds for any scan of settled fits, for each k: every row has a cluster, no cluster is empty, no row is nearer
    to the mean of another cluster, silhouettes lie between -1 and 1, and no start alone costs less than the one kept."""
    rows = staged(b.vectors(spark, d), "scan")
    fits = km.fit_many(rows, "vec_id", starts=4)
    first = [x for f in fits if f.start == 0 for x in (F.lit(f.k), F.lit(f.cost))]
    scan = km.scan_k(rows, "vec_id", fits=fits).select("k", "n_clusters", "cost", F.col("silhouette").between(-1, 1).alias("in_range"))
    cheap = F.col("cost") <= F.element_at(F.create_map(*first), F.col("k")) * (1 + 1e-9)
    return km.label_means(rows, km.best_of(fits)).join(scan, "k").select(
        "k", "n_rows", F.col("n_clusters").cast("long").alias("n_clusters"), "n_elsewhere", "in_range", cheap.alias("best_of_starts"))


def _tfidf_sql(group: str, max_terms: int) -> str:
    return f"""WITH tok AS (SELECT {group}, unnest(regexp_extract_all(lower(text), '[{b.W}]{{2,}}')) AS term FROM documents),
 tf AS (SELECT {group}, term, count(*) AS tf FROM tok WHERE term NOT IN {b.names_in(STOP_WORDS)} GROUP BY ALL),
 vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {max_terms}),
 w AS (SELECT {group}, term, tf, tf * (ln((1 + (SELECT count(DISTINCT {group}) FROM documents)::DOUBLE) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)),
 f AS (SELECT {group}, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY {group})) AS weight FROM w)"""


@query(_tfidf_sql("source", 5000) + """, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(weight, 9) DESC, term)::INT AS rank FROM f)
 SELECT * FROM r WHERE rank <= 15""")
def cluster_terms(spark, d):
    return ft.cluster_terms(texts(spark, d, "documents"), "source", "text", STOP_WORDS)


@query(_tfidf_sql("doc_id", 5000) + " SELECT * FROM f")
def tfidf_features(spark, d):
    return ft.tfidf(texts(spark, d, "documents"), "doc_id", "text", STOP_WORDS)


# ---- classifier ---------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1)
 SELECT lang, n, (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n) AS weight FROM c""")
def class_weights(spark, d):
    return md.class_weights(load(spark, d, "documents"), "lang")


def _labelled(spark, d):
    return texts(spark, d, "documents").join(load(spark, d, "labels"), "doc_id").select(
        "doc_id", "text", F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("intent")
    )


@query()
def train_classifier(spark, d):
    """Training accuracy of the unbalanced fit on the labelled documents."""
    rows = _labelled(spark, d)
    scored = md.classify(rows, md.train_classifier(rows, "text", "intent", stop_words=STOP_WORDS))
    return scored.agg(F.count("*").alias("n"), F.avg((F.col("intent") == F.col("predicted_intent")).cast("double")).alias("accuracy"))


@query()
def score_classifier(spark, d):
    """Every document labelled by the fit on the labelled ones."""
    model = md.train_classifier(_labelled(spark, d), "text", "intent", stop_words=STOP_WORDS)
    return md.classify(texts(spark, d, "documents"), model).select("doc_id", "predicted_intent")


@query()
def corpus_backfill(spark, d):
    """Replies of the corpus with an intent from the balanced fit."""
    model = md.train_classifier(_labelled(spark, d), "text", "intent", balanced=True, stop_words=STOP_WORDS)
    corpus = b.clean_pairs(spark, d).select("brand_reply_id", F.col("customer_tweet_clean").alias("text"))
    return md.classify(corpus, model).select("brand_reply_id", "predicted_intent")
