"""Balanced shards by label propagation, documents of equal text linked.

Linked rows start in the shards in equal runs of their order, so groups lie in many shards. A group's label is the shard
of its first row; its members in a shard are votes for it. In each round labels change to the shard with most votes, or,
where a shard has too many groups, to the shard with room that has most. How many may change between two shards is a
quota: exchanges in equal numbers both ways, and free places. Both are counted for each size of group, as a plan on the
number of groups of each size gives every shard its places: larger groups first, in the shard with the least room that
holds them. Rounds end when no label may change. The members then follow their label, and groups that no shard has a
place for are cut over the largest rooms. Documents without links fill the places that are left, so the counts end at
most one apart whatever the groups' sizes.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_triage.llm.common import bucket_ranks, staged

SHARDS = 16
RANKED_ROWS = 8192


def quotas(wanted: dict[tuple[int, int], int], held: list[int], places: list[int]) -> dict[tuple[int, int], int]:
    """How many of those that want from s to t may move, so that no shard ends above its places."""
    grant = {(s, t): min(n, wanted.get((t, s), 0)) for (s, t), n in wanted.items()}
    free = [p - h for p, h in zip(places, held)]
    changed = True
    while changed:
        changed = False
        for (s, t), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
            more = min(n - grant[s, t], free[t])
            if more > 0:
                grant[s, t] += more
                free[t] -= more
                free[s] += more
                changed = True
    return {k: n for k, n in grant.items() if n}


def plan(sizes: dict[int, int], places: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int, int]]]:
    """(whole, cut) of groups counted by size: (size, first rank, end rank, shard) of groups that stay whole, by their
    rank among those of their size, and (size, rank, first member, end member, shard) of the parts of the others, at
    most one group for each shard that they fill."""
    room, whole, cut = list(places), [], []
    for size in sorted(sizes, reverse=True):
        rank = 0
        while rank < sizes[size]:
            fits = [s for s in range(len(room)) if room[s] >= size]
            if fits:
                s = min(fits, key=lambda s: (room[s], s))
                n = min(sizes[size] - rank, room[s] // size)
                whole.append((size, rank, rank + n, s))
                room[s] -= n * size
                rank += n
                continue
            at = 0
            while at < size:
                rest = [s for s in range(len(room)) if room[s] >= size - at]
                s = min(rest, key=lambda s: (room[s], s)) if rest else max(range(len(room)), key=lambda s: (room[s], -s))
                end = min(size, at + room[s])
                cut.append((size, rank, at, end, s))
                room[s] -= end - at
                at = end
            rank += 1
    return whole, cut


def _held(rows: DataFrame, shards: int) -> list[int]:
    n = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # one row a shard
    return [n.get(s, 0) for s in range(shards)]


def _cells(spark: SparkSession, numbers: dict[tuple[int, int], int], shard: str, name: str) -> DataFrame:
    return spark.createDataFrame([(n, s, x) for (n, s), x in numbers.items()], f"n bigint, {shard} int, {name} bigint")


def start(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with ``shard``: dealt in equal runs of their order by ``row``, a monotonically_increasing_id, which has
    the partition from bit 33 on and the place in it below."""
    part = F.shiftright("row", 33)
    counts = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row a partition of the input
    first, total = [], 0
    for p in sorted(counts):
        first.append((p, total))
        total += counts[p]
    runs = rows.sparkSession.createDataFrame(first, "part bigint, first bigint")
    place = F.col("first") + F.col("row") - F.shiftleft("part", 33)
    return rows.withColumn("part", part).join(F.broadcast(runs), "part").withColumn(
        "shard", F.floor(place * shards / max(1, total)).cast("int")).drop("part", "first")


def _too_many(labels: DataFrame, held: dict[tuple[int, int], int], places: dict[tuple[int, int], int],
              buckets: int) -> DataFrame:
    """The groups of ``labels`` (grp, n, shard, votes) beyond the places that their shard has for their size; those with
    most votes there have the places."""
    full = {c: places.get(c, 0) for c, h in held.items() if h > places.get(c, 0)}
    keys = ["n", "shard", "votes"]
    rows = staged(labels.join(_cells(labels.sparkSession, full, "shard", "places"), ["n", "shard"]), "sharding-full")
    above = Window.partitionBy("n", "shard").orderBy(F.desc("votes")).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("same"))
    above = counts.select(*keys, F.coalesce(F.sum("same").over(above), F.lit(0)).alias("above"))
    ranked = bucket_ranks(rows, keys, [F.col("grp")], F.col("grp"), buckets, "rank")
    return ranked.join(above, keys).filter(F.col("above") + F.col("rank") >= F.col("places")).select("grp", *keys)


def propagate(linked: DataFrame, groups: DataFrame, places: list[int], buckets: int) -> DataFrame:
    """``linked`` (row, grp, shard) with each of the ``groups`` (grp, n) in one shard, or cut as ``plan`` cuts it, no
    shard above its ``places``; written.

    Rounds turn to the most votes of all and to the most votes among shards with room by turns. Each change of the first
    kind adds votes and none of them fills a shard beyond its places; each of the second kind takes a group out of a
    shard with too many. So rounds end, and what then has no place is as many groups of each size as the plan cuts.
    """
    spark, shards = linked.sparkSession, range(len(places))
    sizes = {r["n"]: r["groups"] for r in groups.groupBy("n").agg(F.count("*").alias("groups")).collect()}  # different sizes are few
    whole, cut = plan(sizes, places)
    own = {(n, s): end - first for n, first, end, s in whole}  # places by size and shard, in groups
    votes = staged(linked.groupBy("grp", "shard").agg(F.count("*").alias("votes"), F.min("row").alias("row")).join(
        groups, "grp"), "sharding-votes")
    labels = staged(votes.groupBy("grp", "n").agg(F.min(F.struct("row", "shard", "votes")).alias("x")).select(
        "grp", "n", "x.shard", "x.votes"), "sharding-labels")
    held = {(r["n"], r["shard"]): r["count"] for r in labels.groupBy("n", "shard").count().collect()}
    order = [F.col("votes"), F.xxhash64("grp", "shard").alias("h"), F.col("shard")]
    best = staged(votes.join(_cells(spark, own, "shard", "places"), ["n", "shard"]).groupBy("grp").agg(
        F.max(F.struct(*order)).alias("x")).select("grp", F.col("x.shard").alias("to"), F.col("x.votes").alias("most")), "sharding-best")
    number, idle = -1, 0
    while idle < 2:  # neither exchanges nor free places are left to use
        number, idle = number + 1, idle + 1
        if number % 2:
            room = {c: n - held.get(c, 0) for c, n in own.items() if n > held.get(c, 0)}
            wanting = {n for n, _ in room}
            crowded = {c: h for c, h in held.items() if h > own.get(c, 0) and c[0] in wanting}
            if not crowded:
                continue
            offers = _too_many(labels, crowded, own, buckets).select("grp", "n", F.col("shard").alias("from")).join(
                _cells(spark, room, "shard", "room"), "n").join(votes.select("grp", "shard", "votes"), ["grp", "shard"], "left").fillna(0, "votes")
            asking = offers.groupBy("grp", "n", "from").agg(F.max(F.struct(*order)).alias("x")).select(
                "grp", "n", F.col("from").alias("shard"), F.col("x.shard").alias("to"), F.col("x.votes").alias("most"))
        else:
            asking = labels.join(best, "grp").filter("most > votes").drop("votes")
        asking = staged(asking, "sharding-asking")
        wanted: dict[int, dict[tuple[int, int], int]] = {}
        for r in asking.groupBy("n", "shard", "to").count().collect():  # at most a number for each size and pair of shards
            wanted.setdefault(r["n"], {})[r["shard"], r["to"]] = r["count"]
        grants = [(n, s, t, k) for n, w in wanted.items() for (s, t), k in quotas(
            w, [held.get((n, s), 0) for s in shards], [own.get((n, s), 0) for s in shards]).items()]
        if not grants:
            continue
        idle = 0
        for n, s, t, k in grants:
            held[n, s] = held.get((n, s), 0) - k
            held[n, t] = held.get((n, t), 0) + k
        granted = spark.createDataFrame(grants, "n bigint, shard int, to int, granted bigint")
        moves = bucket_ranks(asking, ["n", "shard", "to"], [F.col("grp")], F.col("grp"), buckets, "rank").join(
            granted, ["n", "shard", "to"]).filter("rank < granted").select("grp", "to", "most")
        labels = staged(labels.join(moves, "grp", "left").select(
            "grp", "n", F.coalesce("to", "shard").alias("shard"), F.coalesce("most", "votes").alias("votes")), "sharding-labels")
    members = linked.select("row", "grp")
    if not cut:
        return staged(members.join(labels.select("grp", "shard"), "grp").select("row", "grp", "shard"), "sharding-linked")
    rest = staged(_too_many(labels, held, own, buckets).select("grp", "n"), "sharding-cut")
    split = bucket_ranks(rest, ["n"], [F.col("grp")], F.col("grp"), buckets, "of")
    inside = bucket_ranks(staged(members.join(split, "grp"), "sharding-cut-members"), ["grp"], [F.col("row")], F.col("row"), buckets, "rank")
    uncut = Counter()
    for n, first, end, _ in whole:
        uncut[n] += end - first
    parts = spark.createDataFrame([(n, of - uncut[n], first, end, s) for n, of, first, end, s in cut],
                                  "n bigint, of bigint, first bigint, end bigint, shard int")
    return staged(members.join(labels.join(rest, "grp", "left_anti").select("grp", "shard"), "grp").select("row", "grp", "shard").unionByName(
        inside.join(parts, ["n", "of"]).filter(F.col("rank").between(F.col("first"), F.col("end") - 1)).select("row", "grp", "shard")),
        "sharding-linked")


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    The law is ``rows``: the shards' counts are at most one apart. Texts that are equal are linked; a null text is
    linked with nothing and counts as empty. ``slot`` numbers a shard's rows from 0 without gaps. Rows that share an
    id are placed apart. A group larger than a shard fills several.
    """
    text = F.col(text_col).cast("string")
    base = staged(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("grp"), F.monotonically_increasing_id().alias("row"),
    ), "sharding-base")
    total = base.count()
    places = [total // shards + (s < total % shards) for s in range(shards)]
    buckets = max(1, total // RANKED_ROWS)
    order = [F.col("row")]
    groups = staged(base.filter("grp is not null").groupBy("grp").agg(F.count("*").alias("n")).filter("n > 1"), "sharding-groups")
    split = staged(base.select("row", "grp").join(groups, "grp", "left").select(
        "row", F.when(F.col("n").isNotNull(), F.col("grp")).alias("grp"), F.col("n").isNotNull().alias("linked")),
        "sharding-split")
    dealt = staged(bucket_ranks(split, ["linked"], order, F.col("row"), buckets, "rank"), "sharding-dealt")
    linked = propagate(staged(start(split, shards).filter("linked").select("row", "grp", "shard"), "sharding-start"), groups, places, buckets)
    held = _held(linked, shards)
    place, upto = F.lit(0), 0
    for s in range(shards):  # singles in rank order fill what is left, shard after shard
        place = F.when(F.col("rank") >= upto, F.lit(s)).otherwise(place)
        upto += places[s] - held[s]
    alone = dealt.filter("not linked").select("row", place.cast("int").alias("shard"))
    placed = staged(base.drop("grp").join(linked.select("row", "shard").unionByName(alone), "row"), "sharding-placed")
    return bucket_ranks(placed, ["shard"], order, F.col("row"), buckets, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def cut_edges(rows: DataFrame, group_col: str, shard_col: str = "shard") -> DataFrame:
    """One row: pairs of linked documents (``pairs``) and those whose shards differ (``cut``), from counts alone."""
    cells = rows.groupBy(group_col, shard_col).agg(F.count("*").alias("n"))
    by = cells.groupBy(group_col).agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same"))
    return by.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"),
                  F.sum(F.col("n") * (F.col("n") - 1) / 2 - F.col("same")).alias("cut"))
