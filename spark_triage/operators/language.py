"""Language identification of a column: character-trigram naive Bayes, trained by grouping, scored in blocks of rows.

Trigrams are found and scored by array operations, all texts of a stretch at once. A profile of bounded size is sent to the
tasks. A larger one is a table and stays one, however many trigrams it has: rows are cut into blocks of bounded bytes; each
block lists its distinct trigrams, these are joined with the profile, and the weights that a block asked for return to it.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from spark_triage.session import staged

BLOCK_BYTES = 4 << 20  # of rows in a block
STRETCH = 1 << 20  # characters of whole texts looked at together
TABLE = 1 << 22  # trigrams of a stretch are found by a table up to this many possible ones
SENT_GRAMS = 1 << 18  # trigrams of a profile that goes to the tasks
_LOWERED = "__lowered"
_POINTS = 0x110000
_CODE = (1 << 21) - 1  # a code point


def _letters(text: Column) -> Column:
    """The lower-cased letters, words parted and enclosed by single spaces; NULL without a letter."""
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.when(letters != "", F.concat(F.lit(" "), letters, F.lit(" ")))


def trigrams(text: Column) -> Column:
    """Overlapping code-point trigrams of ``_letters``."""
    return F.regexp_extract_all(_letters(text), F.lit("(?s)(?=(...))."), F.lit(1))


def _lowered(text: Column) -> Column:
    """The lower-cased text, ended by a space so that texts laid end to end share no word."""
    return F.concat(F.lower(text.cast("string")), F.lit(" "))


@functools.cache
def _letter_points(spark: SparkSession) -> np.ndarray:
    """For every code point whether Spark's regular expressions take it for a letter."""
    points = spark.range(0, _POINTS, 1, 1).filter("id not between 55296 and 57343")  # no surrogates
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = points.filter(char.rlike(r"\p{L}")).select("id").toArrow().column(0).to_numpy()
    letter = np.zeros(_POINTS, bool)
    letter[found] = True
    return letter


def _grams(lowered: pa.Array, letter: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, trigrams, row of each) of ``_lowered`` texts in turn, some whole texts at a time: words parted and
    enclosed by single spaces. With n code points, the trigram of those numbered a, b and c is (a n + b) n + c."""
    lowered = lowered.fill_null("").cast(pa.large_string())
    size = pc.utf8_length(lowered).to_numpy()
    part = np.cumsum(size) // STRETCH
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
    for at, end in zip(cuts, np.append(cuts[1:], len(size))):
        own = lowered.slice(at, end - at)
        ends = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
        if ends[0] == ends[-1]:
            continue
        raw = own.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0]))
        codes = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), "<u4")
        is_letter = letter[codes]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]  # and the first of what follows a word
        is_letter = np.append(False, is_letter[keep])
        codes = np.append(np.uint32(32), np.where(is_letter[1:], codes[keep], np.uint32(32)))
        row = np.append(-1, np.repeat(np.arange(at, end), size[at:end])[keep])
        there = np.zeros(_POINTS, bool)
        there[codes] = True
        points = np.flatnonzero(there)
        number = np.zeros(_POINTS, np.int64)
        number[points] = np.arange(len(points))
        c, n = number[codes], len(points)
        whole = is_letter[1:-1] | (row[:-2] == row[2:])  # not the last letter of a text and the first of the next
        yield points, (((c[:-2] * n) + c[1:-1]) * n + c[2:])[whole], row[1:-1][whole]


def _distinct(values: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """(the different values in order, place of each value among them); by a table where ``upto`` is small."""
    if upto > TABLE:
        return np.unique(values, return_inverse=True)
    there = np.zeros(upto, bool)
    there[values] = True
    found = np.flatnonzero(there)
    place = np.zeros(upto, np.int64)
    place[found] = np.arange(len(found))
    return found, place[values]


def _keys(points: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The numbers of ``_grams`` as those of ``_as_keys``."""
    n = len(points)
    return points[grams // (n * n)] << 42 | points[grams // n % n] << 21 | points[grams % n]


def _as_text(keys: np.ndarray) -> list[str]:
    points = np.stack([keys >> 42, keys >> 21 & _CODE, keys & _CODE], 1).astype("<u4")
    joined = points.tobytes().decode("utf-32-le")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)]


def _as_keys(grams: list[str]) -> np.ndarray:
    c = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").astype(np.int64).reshape(-1, 3)
    return c[:, 0] << 42 | c[:, 1] << 21 | c[:, 2]


def language_profile(labelled: DataFrame, text_col: str, lang_col: str, languages: Sequence[str]) -> DataFrame:
    """(gram, w_<lang>.., z_<lang>..): w = ln(count + 1), z = ln(total + vocabulary), add-one smoothed.

    Every trigram of every labelled row counts, and there is no bound on rows or trigrams: a task counts what it sees,
    the counts are added up by trigram and written once.
    """
    held = labelled.sparkSession.sparkContext.broadcast(_letter_points(labelled.sparkSession))
    counted = StructType.fromDDL("gram string, " + ", ".join(f"`{x}` bigint" for x in languages))
    target = to_arrow_schema(counted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column(1).to_pylist()], np.int64)
            for points, seen, row in _grams(batch.column(0), held.value):
                grams, place = _distinct(seen, len(points) ** 3)
                n = np.bincount(place * len(languages) + lang[row], minlength=len(grams) * len(languages)).reshape(len(grams), -1)
                yield pa.RecordBatch.from_arrays([pa.array(_as_text(_keys(points, grams))), *map(pa.array, n.T.copy())], schema=target)

    rows = labelled.filter(F.col(lang_col).isin(*languages)).select(_lowered(F.col(text_col)).alias("t"), F.col(lang_col).alias("l"))
    per_task = rows.filter("t is not null").mapInArrow(count, counted)
    counts = staged(per_task.groupBy("gram").agg(*[F.sum(x).alias(x) for x in languages]), "language-counts")
    total = [F.ln((F.sum(x) + F.count("*")).cast("double")).alias(x) for x in languages]
    z = counts.agg(F.struct(*total).alias("z")).scalar()
    return counts.withColumn("z", z).select(
        "gram", *[F.ln(F.col(x) + 1).alias(f"w_{x}") for x in languages], *[F.col("z")[x].alias(f"z_{x}") for x in languages])


def _blocks(df: DataFrame, text_col: str) -> DataFrame:
    """(block, grams, rows): rows of ``df`` with their lowered text in blocks of bounded bytes, and the distinct trigrams of
    each block; written, so that a block keeps its name."""
    held = df.sparkSession.sparkContext.broadcast(_letter_points(df.sparkSession))
    rows = df.withColumn(_LOWERED, _lowered(F.col(text_col)))
    kind = StructType([StructField("block", StringType()), StructField("grams", ArrayType(StringType())),
                       StructField("rows", ArrayType(rows.schema))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * BLOCK_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                own = batch.slice(at, step)
                found = [_keys(points, _distinct(seen, len(points) ** 3)[0])
                         for points, seen, _ in _grams(own.column(own.num_columns - 1), held.value)]
                grams = _as_text(np.unique(np.concatenate(found))) if found else []
                packed = pa.StructArray.from_arrays(own.columns, fields=list(own.schema))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([grams], pa.list_(pa.string())),
                     pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), packed)], ["block", "grams", "rows"])

    return staged(rows.mapInArrow(cut, kind), "language-blocks")


def detect_language(
    df: DataFrame, text_col: str, profile: DataFrame, languages: Sequence[str], out: str = "detected",
    sent_grams: int = SENT_GRAMS,
) -> DataFrame:
    """``df`` with ``out``, the language of each row's text; NULL where the text has no known trigram.

    A profile of at most ``sent_grams`` trigrams goes to the tasks, which read the rows once. Beyond it rows travel in
    blocks, each as it was, and the profile stays a table. Repeated rows and ids do not matter. Equal scores take the first
    language by name.
    """
    names = sorted(languages)
    spark = df.sparkSession
    weighted = profile.select("gram", F.array(*[f"w_{x}" for x in names]).alias("w"))
    z = profile.agg(F.array(*[F.max(f"z_{x}") for x in names]).alias("z"))
    schema = StructType([*(f for f in df.schema if f.name != out), StructField(out, StringType())])
    target = to_arrow_schema(schema)
    letter = spark.sparkContext.broadcast(_letter_points(spark))

    def labelled(rows: pa.RecordBatch, known: tuple | None) -> pa.RecordBatch:
        found = _best(rows.column(rows.num_columns - 1), known, names, letter.value)
        rows = rows.drop_columns([_LOWERED, *([out] if out in rows.schema.names else [])])
        return pa.RecordBatch.from_arrays([*rows.columns, found], schema=target)

    few = weighted.limit(sent_grams + 1).toArrow()
    if few.num_rows <= sent_grams:
        sent = spark.sparkContext.broadcast(_weights(few, z.toArrow(), names))

        def score_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield labelled(batch, sent.value)

        return df.withColumn(_LOWERED, _lowered(F.col(text_col))).mapInArrow(score_sent, schema)

    blocks = _blocks(df, text_col)
    asked = blocks.select("block", F.explode("grams").alias("gram"))
    answered = asked.join(weighted, "gram").groupBy("block").agg(
        F.collect_list(F.struct("gram", "w")).alias("known"))  # at most the grams of a block

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = pa.RecordBatch.from_struct_array(batch.column("rows").slice(i, 1).flatten())
                known, z = (batch.column(c).slice(i, 1) for c in ("known", "z"))
                own = known.flatten()
                yield labelled(rows, None if known.null_count else _weights(
                    pa.table([own.field("gram"), own.field("w")], ["gram", "w"]), pa.table([z], ["z"]), names))

    joined = blocks.select("block", "rows").join(answered, "block", "left").select("rows", "known", z.scalar().alias("z"))
    return joined.mapInArrow(score, schema)


def _weights(known: pa.Table, z: pa.Table, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(keys in order, weights of each, z) of trigrams (gram, w); None without any."""
    if not known.num_rows:
        return None
    keys = _as_keys(known["gram"].to_pylist())
    order = np.argsort(keys)
    weights = known["w"].combine_chunks().flatten().to_numpy().reshape(len(keys), len(names))
    return keys[order], weights[order], z["z"].combine_chunks().flatten().to_numpy()


def _best(lowered: pa.Array, known: tuple | None, names: list[str], letter: np.ndarray) -> pa.Array:
    """The best language of each text, by the weights of ``_weights``."""
    if known is None or not len(lowered):
        return pa.nulls(len(lowered), pa.string())
    keys, weights, z = known
    weights = np.append(weights, np.zeros((1, len(names))), 0)  # of trigrams that are not known
    total, seen = np.zeros((len(lowered), len(names))), np.zeros(len(lowered), bool)
    size = np.zeros(len(lowered), np.int64)
    for points, found, row in _grams(lowered, letter):
        if not len(found):
            continue
        grams, place = _distinct(found, len(points) ** 3)
        own = _keys(points, grams)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        at = np.where(keys[at] == own, at, len(keys))[place]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        here = row[first]
        total[here] += np.add.reduceat(weights[at], first)
        seen[here] |= np.logical_or.reduceat(at < len(keys), first)
        size[here] += np.diff(np.append(first, len(row)))
    best = (total - size[:, None] * z).argmax(1)
    return pa.DictionaryArray.from_arrays(pa.array(best, mask=~seen), pa.array(names)).cast(pa.string())


def language_filter(df: DataFrame, detected_col: str = "detected", language: str = "en") -> DataFrame:
    """Rows detected as ``language``; undetected ones are dropped too."""
    return df.filter(F.col(detected_col) == language)
