"""Personal data: exact base spans, and further spans chosen by boosted trees. DataFrame and SQL functions only.

Base spans of four kinds come from patterns and checks. Loose generators propose candidates around them, overlapping
at will; gradient-boosted trees score each by its form and its context, and a threshold for each kind, calibrated on
held-out rows, selects those that are added. The trees are fitted on seven tenths of the different labelled candidates of
all documents, the thresholds on the other three, none left out; weights keep a frequent kind and label from outweighing
the others. Positive are base spans, variants of them written another way, and candidates that
touch none but pass the checks of their kind once rewritten and are announced as such; negative are those that follow
an order number's word, are part of a longer name, or fail the checks; what is left open trains nothing. The fitted
trees become one SQL expression, so scoring is a projection over the documents, without a shuffle.

Patterns repeat possessively and start where a run starts or where the last match ended: the same matches as the plain
ones, in linear time and without deep recursion on long runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triage.llm.common import staged

#: The kinds in order, their patterns and the digits they may have.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: What each generator proposes, and a sign without which a text has none of it.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+)*+",
    "ip": r"[0-9]{1,4}+(?:\x20?[.,]\x20?[0-9]{1,4}+){3,5}+",
    "card": r"[0-9](?:[\x20.-]{0,2}+[0-9]){11,22}+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,2}+[0-9]){6,15}+",
}
SIGNS = {"email": r"@|\((?:at)\)|\[at\]", "ip": "[0-9]", "card": "[0-9]{2}", "phone": "[0-9]{2}"}
#: Words that announce a kind.
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach)\b", "ip": r"(?i)\b(?:ip|host|server|address|from)\b",
    "card": r"(?i)\b(?:card|visa|credit|debit|payment|mastercard)\b", "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|cell)\b",
}
#: Words before a number that is something else, and the forms of dates and times.
OTHER = (r"(?i)(?:#|\b(?:order|invoice|ticket|ref|reference|serial|lot|sku|item|part|id|number|no|nr|version|ver|v|release|build|"
         r"date|dated|token|key|hash|sum)\b)[\s.:=#\"'-]*$")
DATE = r"^(?:[0-9]{4}[-.][0-9]{1,2}[-.][0-9]{1,2}|[0-9]{1,2}[-.][0-9]{1,2}[-.][0-9]{4})(?:$|[\x20.-])"
CONTEXT = 24
BALANCE_ROWS = 6_000  # as much as all kinds and labels together weigh at most when trees are fitted
TREES, DEPTH = 12, 3
PRECISION, LEAST_HELD = 0.98, 20
DECIMALS = 4  # scores are compared at this precision, so a kind has at most 10,001 of them
_FOUND = "array<struct<start:int,end:int,kind:int,m:string,before:string,after:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")  # i-th from the right, from 0
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        short = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        low = lambda p: F.coalesce(F.when(short(p), F.right(p, F.lit(3)).cast("int")) <= 255, F.lit(False))
        return F.forall(F.split(m, r"\."), low)
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(*CARD_DIGITS), _luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(*PHONE_DIGITS)
    return F.lit(True)


def _check(kind: str):
    return lambda x: _valid(kind, x.m)


def _with_matches(df: DataFrame, name: str, pattern: str, kind: int, sign: str | None = None) -> DataFrame:
    """``df`` with ``name``: the matches of ``pattern`` in ``text`` and their places in code points."""
    m, gap = f"{name}_m", f"{name}_g"
    has = F.col("text").rlike(pattern)
    has = F.col("text").rlike(sign) & has if sign else has
    df = df.withColumn(f"{name}_h", has)
    df = df.withColumn(m, F.when(F.col(f"{name}_h"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn(gap, F.when(F.col(f"{name}_h"), F.split("text", pattern, -1)))
    n = F.size(m)
    parts = F.zip_with(
        F.zip_with(F.slice(gap, F.lit(1), n), m, lambda g, x: F.struct(
            F.length(g).alias("gap"), x.alias("m"), F.right(g, F.lit(CONTEXT)).alias("before"))),
        F.slice(gap, F.lit(2), n),
        lambda x, g: F.struct(x.gap.alias("gap"), x.m.alias("m"), x.before.alias("before"), F.left(g, F.lit(CONTEXT)).alias("after")))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(_FOUND).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc.pos + x.gap
        end = at + F.length(x.m)
        item = F.struct(at.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x.m.alias("m"),
                        x.before.alias("before"), x.after.alias("after"))
        return F.struct(end.alias("pos"), F.concat(acc.out, F.array(item)).alias("out"))

    found = F.when(F.col(f"{name}_h"), F.aggregate(parts, start, step, lambda acc: acc.out))
    return df.withColumn(name, F.coalesce(found, F.array().cast(_FOUND))).drop(m, gap, f"{name}_h")


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (.., text) with ``base``: the valid base spans by start, then kind."""
    for k, kind in enumerate(KINDS):
        docs = _with_matches(docs, f"_{kind}", BASE[kind], k)
        docs = docs.withColumn(f"_{kind}", F.filter(f"_{kind}", _check(kind)))
    order = F.array_sort(
        F.concat(*[f"_{kind}" for kind in KINDS]),
        lambda a, b: F.when(a.start != b.start, a.start - b.start).when(a.kind != b.kind, a.kind - b.kind).otherwise(F.lit(0)))
    return docs.withColumn("base", order).drop(*[f"_{kind}" for kind in KINDS])


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (.., text, base) with ``candidates``: what the generators propose; ``known``: it touches a base span."""
    for k, kind in enumerate(KINDS):
        docs = _with_matches(docs, f"_{kind}", LOOSE[kind], k, SIGNS[kind])
    touches = lambda x: F.exists("base", lambda b: (b.start < x.end) & (x.start < b.end))
    return docs.withColumn("candidates", F.transform(
        F.concat(*[f"_{kind}" for kind in KINDS]), lambda x: x.withField("known", touches(x)))).drop(*[f"_{kind}" for kind in KINDS])


def _cue(kind: Column, before: Column) -> Column:
    """How many words that announce the kind stand before."""
    return reduce(lambda out, k: F.when(kind == k, F.regexp_count(before, F.lit(CUES[KINDS[k]]))).otherwise(out),
                  range(len(KINDS)), F.lit(0))


def _other(m: Column, before: Column) -> Column:
    """Whether a candidate is announced as something else or has the form of a date."""
    return before.rlike(OTHER) | m.rlike(DATE)


def _sound(kind: Column, m: Column) -> Column:
    """Whether a candidate, rewritten in the plain form of its kind, is a match that counts."""
    dotted = F.regexp_replace(F.regexp_replace(m, r"\x20?(?:\(dot\)|\[dot\])\x20?", "."), r"\x20?(?:\(at\)|\[at\])\x20?", "@")
    plain = {
        "email": F.regexp_replace(dotted, r"\x20", ""), "ip": F.regexp_replace(m, r"\x20", ""),
        "card": _digits(m), "phone": F.concat(F.lit("+"), _digits(m)),
    }
    return reduce(lambda out, k: F.when(kind == k, plain[KINDS[k]].rlike(f"^(?:{BASE[KINDS[k]]})$") & _valid(KINDS[k], plain[KINDS[k]]))
                  .otherwise(out), range(len(KINDS)), F.lit(False))


def label(kind: Column, m: Column, before: Column, after: Column, known: Column, same: Column) -> Column:
    """1, 0 or, where the rules leave it open, null. ``same``: it touches a base span of its own kind."""
    joined = (kind != 0) & (before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"))
    told = (_cue(kind, before) > 0) | ((kind == 0) & m.rlike(r"\((?:at)\)|\[at\]"))
    other = joined | ((kind != 0) & _other(m, before))
    return (F.when(same, F.lit(1)).when(known, F.lit(None)).when(other, F.lit(0)).when(_sound(kind, m), F.when(told, F.lit(1)))
            .when(told, F.lit(None)).otherwise(F.lit(0)))


def features(kind: Column, m: Column, before: Column, after: Column) -> list[Column]:
    """Form and context of a candidate, as numbers."""
    count = lambda pattern: F.length(F.regexp_replace(m, pattern, ""))
    flag = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    n = count("[^0-9]")
    out = [
        kind, F.length(m), n, count("[^A-Za-z]"), count("[A-Za-z0-9]"), count(r"[^.]"), flag(m.startswith("+")),
        flag(m.contains("(")), F.size(F.split(m, "[^0-9]+", -1)), flag(m.contains("@")),
        flag(F.when(n.between(12, 19), _luhn(_digits(m))).otherwise(F.lit(False))),
        flag(before.rlike(r"[A-Za-z0-9]$")), flag(after.rlike(r"^[A-Za-z0-9]")), flag(before.rlike(r"[=#:$/_-]\s*$")),
        flag(after.rlike(r"^[.,-][0-9]")), _cue(kind, before), flag(m.rlike(r"(?:^|[.,\x20])(?:25[6-9]|2[6-9][0-9]|[3-9][0-9]{2}|[0-9]{4})(?:$|[.,\x20])")),
        F.length(F.regexp_replace(m, r"(?s)^.*[^0-9](?=[0-9]*$)", "")),
        flag(_other(m, before)),
    ]
    return [c.cast("double") for c in out]


def _variants(kind: Column, m: Column) -> Column:
    """The same datum written another way."""
    plain = _digits(m)
    grouped = F.trim(F.regexp_replace(plain, "([0-9]{4})", "$1 "))
    return (
        F.when(kind == 0, F.array(m, F.replace(m, F.lit("@"), F.lit(" (at) ")), F.replace(m, F.lit("@"), F.lit("[at]"))))
        .when(kind == 1, F.array(m, F.replace(m, F.lit("."), F.lit(" . "))))
        .when(kind == 2, F.array(m, grouped, F.replace(grouped, F.lit(" "), F.lit("."))))
        .otherwise(F.array(m, F.ltrim(F.lit("+"), m), F.regexp_replace(F.ltrim(F.lit("+"), m), r"[\x20-]", "."))))


def _tree(node, columns: list[Column]) -> Column:
    """A fitted tree as one expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    left, right = _tree(node.leftChild(), columns), _tree(node.rightChild(), columns)
    return F.when(columns[split.featureIndex()] <= F.lit(float(split.threshold())), left).otherwise(right)


class Model:
    """Fitted trees with a threshold for each kind; without trees nothing is added."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, kind: Column, m: Column, before: Column, after: Column) -> Column:
        columns = features(kind, m, before, after)
        margin = reduce(lambda a, b: a + b, [_tree(t, columns) * w for t, w in zip(self.trees, self.weights)], F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * margin))

    def selects(self, x: Column) -> Column:
        if not self.trees or not self.thresholds:
            return F.lit(False)
        least = reduce(lambda out, k: F.when(x.kind == k, F.lit(self.thresholds[k])).otherwise(out), self.thresholds, F.lit(2.0))
        return F.round(self.score(x.kind, x.m, x.before, x.after), DECIMALS) >= least  # rounded as the thresholds are


def _threshold(rows: list, precision: float) -> float | None:
    """The lowest score from which ``rows`` (score, positives, number) are right at ``precision``, if there is one."""
    counted: dict[float, list[int]] = {}
    for score, positives, n in rows:
        old = counted.get(score, [0, 0])
        counted[score] = [old[0] + positives, old[1] + n]
    out, right, total = None, 0, 0
    for score in sorted(counted, reverse=True):
        right, total = right + counted[score][0], total + counted[score][1]
        if total >= LEAST_HELD and right >= precision * total and score >= 0.5:
            out = score
    return out


def fit(docs: DataFrame, balance_rows: int = BALANCE_ROWS, trees: int = TREES, depth: int = DEPTH,
        precision: float = PRECISION) -> Model:
    """Trees fitted on the different labelled candidates of all documents. Three tenths, by hash, are held out for the
    thresholds; all others train. A row weighs one, or less where its kind and label have more rows than an even share of
    ``balance_rows``, so that they weigh that share together. A kind with fewer than ``LEAST_HELD`` held-out rows takes
    the threshold of all."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    found = with_candidates(with_base(docs.select("text")))
    same = lambda x: F.exists("base", lambda b: (b.start < x.end) & (x.start < b.end) & (b.kind == x.kind))
    seen = found.select(F.explode(F.transform("candidates", lambda x: x.withField("same", same(x)))).alias("c")).select("c.*")
    kind, m, before, after = (F.col(c) for c in ("kind", "m", "before", "after"))
    seen = seen.withColumn("label", label(kind, m, before, after, F.col("known"), F.col("same"))).filter("label is not null")
    written = F.when(F.col("same"), _variants(kind, m)).otherwise(F.array("m"))
    rows = seen.select("kind", "before", "after", F.explode(written).alias("m"), "label")
    rows = rows.groupBy("kind", "m", "label").agg(F.min(F.struct(F.xxhash64("before", "after").alias("x"), "before", "after")).alias("c"))
    rows = rows.select("kind", "m", "label", "c.before", "c.after", F.xxhash64("kind", "m", "label").alias("h"))
    pool = staged(rows, "pii-pool")
    there = {(r["kind"], r["label"]): r["count"] for r in pool.groupBy("kind", "label").count().collect()}  # 8 at most
    if len({side for _, side in there}) < 2:
        return Model([], [], {})
    share = {k: min(1.0, balance_rows / (2 * len(KINDS)) / n) for k, n in there.items()}
    weight = reduce(lambda out, k: F.when((kind == k[0]) & (F.col("label") == k[1]), F.lit(share[k])).otherwise(out), share, F.lit(0.0))
    columns = features(kind, m, before, after)
    names = [f"f{i}" for i in range(len(columns))]
    known = staged(pool.select("kind", "m", "before", "after", "label", "h", weight.alias("weight"),
                               *[c.alias(x) for c, x in zip(columns, names)]).sortWithinPartitions("h", "m"), "pii-candidates")
    held = F.pmod(F.col("h"), F.lit(10)) < 3
    sides = {r["label"] for r in known.filter(~held).select("label").distinct().collect()}
    if len(sides) < 2:
        return Model([], [], {})
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(known.filter(~held))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, featuresCol="features", labelCol="label", weightCol="weight").fit(ready)
    model = Model([t._call_java("rootNode") for t in fitted.trees], list(fitted.treeWeights), {})
    score = F.round(model.score(kind, m, before, after), DECIMALS).alias("score")
    scored = [(r["kind"], (r["score"], r["positives"], r["n"])) for r in known.filter(held).groupBy("kind", score).agg(
        F.sum("label").alias("positives"), F.count("*").alias("n")).collect()]  # one row per kind and score
    for k in range(len(KINDS)):
        own = [x for kind_of, x in scored if kind_of == k]
        least = _threshold(own if sum(n for *_, n in own) >= LEAST_HELD else [x for _, x in scored], precision)
        if least is not None:
            model.thresholds[k] = least
    return model


def _named(spans: Column) -> Column:
    kind = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x.kind + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x.start.cast("string"), x.end.cast("string"))), ",")


def _is(kind: int):
    return lambda x: x.kind == kind


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_spans), one row per row of ``docs``, and
    ``row``, a struct of the columns ``keep``, if there are any.

    The counts and the digest are those of the base spans; ``spans`` and ``all_spans`` (array of start, end, kind)
    also hold the added ones. Places are code points, ends exclusive. Null and empty texts have none. A model that is
    not given is fitted on ``docs``; where all candidates have one label nothing is added.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *[F.struct(*keep).alias("row")][: len(keep)])
    model = model or fit(rows.select("text"))
    rows = with_candidates(with_base(rows))
    place = lambda xs: F.transform(xs, lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.end.alias("end")))
    added = F.filter("candidates", lambda x: ~x.known & model.selects(x))
    rows = rows.withColumn("added", added)
    rows = rows.withColumn("all_spans", F.array_sort(F.array_union(place(F.col("base")), place(F.col("added")))))
    return rows.select(
        "doc_id", *[F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(F.encode(_named(F.col("base")), "UTF-8"), 256).alias("base_sha256"), _named(F.col("all_spans")).alias("spans"),
        "all_spans", *["row"][: len(keep)])


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; spans that overlap count as the first."""
    kind = lambda x: F.concat(F.lit("<"), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), x.kind + 1)), F.lit(">"))
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc.pos + 1, x.start - acc.pos)
        fresh = F.struct(x.end.alias("pos"), F.concat(acc.out, gap, kind(x)).alias("out"))
        longer = F.struct(F.greatest(acc.pos, x.end).alias("pos"), acc.out.alias("out"))
        return F.when(x.start >= acc.pos, fresh).otherwise(longer)

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc.out, F.substring(text, acc.pos + 1, F.length(text))))
