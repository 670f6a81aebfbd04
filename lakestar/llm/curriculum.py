"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources share the mix by weight. A source gives at most ``MOST`` times its size; what
it cannot give goes to the others by weight, until none is above.

Taken: the texts of a source stand in a keyed hash order. The mix goes round that order until
the target is met, so every text is taken in whole rounds, and one more time if it lies in the
first part of the last round. The text at the end of that part is taken in part, which meets
the target to the word.

Curriculum: each source has a weight schedule over training time 0 to 1, a line from
``1 - tilt`` to ``1 + tilt`` of its mean, with ``tilt`` from ``-TILT`` for the lightest source to
``TILT`` for the heaviest. The schedule's integral is the share of the source's tokens that is
due by a time; its inverse at a copy's middle token is the copy's training position. Copies are
range-sorted by position, and the query's rows, a document each, are made from the sorted copies.

All of it is DataFrame functions. The running sum of a source is cut into ``SLICES`` by the
leading digits of the hash, so a source with a third of all texts is summed in that many
pieces. Results: NULL text and text without words have size 0 and are never taken. NULL sources
are one source. Rows that repeat id and text have the same place in the order; their order among
themselves does not change any result but theirs. No document, no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.shared import SEPARATOR, saved, table

MOST = 3
WEIGHTS = (1, 2, 3)
TILT = 0.5
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words of the text, without building them: word starts are what the pattern leaves."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(spaced, " ", -1), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, weight, target, tilt)`` from ``(source, source_size)``, a row per source.

    Sources fill up in the order of ``size / weight``. Were the first ``k`` full, the rest would
    share what is left at one level per weight; the highest level that the next source can
    give is the one at which no source is above its bound.
    """
    rank = Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("weight", cycle.cast("long"))
    steps = (
        numbered.withColumn("total", F.sum("source_size").over(every))
        .withColumn("full", F.coalesce(most * F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")).cast("double") / F.col("rest")))
    fits = F.when(F.col("level") * F.col("weight") <= most * F.col("source_size"), F.col("level"))
    chosen = steps.withColumn("level", F.max(fits).over(every))
    target = F.least((most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight"))
    heavy, light = max(weights), min(weights)
    tilt = F.lit(0.0) if heavy == light else TILT * (2 * (F.col("weight") - light) / (heavy - light) - 1)
    return chosen.select("source", "source_size", "weight", target.alias("target"), tilt.cast("double").alias("tilt"))


def due_at(share: Column, tilt: Column) -> Column:
    """The time by which ``share`` of a source's tokens is due.

    The rate ``1 + tilt * (2t - 1)`` integrates to ``(1 - tilt) t + tilt t^2``; solved for t in a form
    that has no difference of near numbers.
    """
    return 2 * share / ((1 - tilt) + F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix") -> DataFrame:
    """A row per document: size, source_size, target, taken, rounds, part, and the position of its first copy.

    ``taken = rounds * size + part``; ``begins`` is where the document's words begin in its source's order.
    """
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    sized = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count(F.col("text").cast("string")).alias("size"), order.alias("place"),
            F.xxhash64(F.col("text").cast("string")).alias("text_key")), "mix-sizes")
    slice_ = F.substring("place", 1, SLICE_DIGITS)
    slices = sized.groupBy("source", slice_.alias("slice")).agg(F.sum("size").alias("slice_size"))
    targets = source_targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, most)
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("offset", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    plan = saved(
        starts.alias("a").join(targets.alias("b"), F.expr("a.source <=> b.source"))
        .select("a.source", "slice", "offset", "source_size", "target", "tilt"), "mix-plan")
    within = Window.partitionBy("d.source", "p.slice").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.alias("d").join(
        plan.alias("p"), F.expr(f"d.source <=> p.source AND substring(d.place, 1, {SLICE_DIGITS}) = p.slice")
    ).select("doc_id", "text_key", "d.source", "size", "source_size", "target", "tilt",
             (F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("begins"))
    goal = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.expr("CAST(round(target) AS BIGINT) DIV nullif(source_size, 0)")).otherwise(F.lit(0)).cast("long")
    rest = goal - F.col("rounds") * F.col("source_size")
    return (
        placed.withColumn("rounds", rounds)
        .withColumn("part", F.greatest(F.lit(0), F.least("size", rest - F.col("begins"))).cast("long"))
        .withColumn("taken", F.col("rounds") * F.col("size") + F.col("part"))
        .withColumn("position", F.when(F.col("taken") > 0, position(F.lit(0)))))


def own_words(round_: Column) -> Column:
    """Words of a document's copy in a round: all, or what is left of the part; NULL without a round."""
    return F.when(round_.isNotNull(), F.least(F.col("size"), F.col("taken") - round_ * F.col("size")))


def position(round_: Column) -> Column:
    """Training position of a document's copy in a round: its middle word on its source's demand curve."""
    middle = round_ * F.col("source_size") + F.col("begins") + own_words(round_) / 2
    share = middle / F.greatest(F.lit(1), F.round("target"))
    return F.when(round_.isNotNull(), due_at(F.least(F.lit(1.0), share), F.col("tilt")))


def scheduled(mixed: DataFrame) -> DataFrame:
    """A row per copy of a document, with its words and training position, range-sorted by position.

    Documents that are not taken follow as one row each, without round, words and position.
    """
    n = (F.col("rounds") + (F.col("part") > 0).cast("long")).cast("int")
    return (
        mixed.withColumn("round", F.explode_outer(F.when(F.col("taken") > 0, F.sequence(F.lit(0), n - 1))))
        .withColumns({"position": position(F.col("round")), "words": own_words(F.col("round"))})
        .orderBy(F.col("position").asc_nulls_last(), "doc_id", "round"))


def copies(mixed: DataFrame) -> DataFrame:
    """The copies alone: a row per copy of a taken document, range-sorted by position."""
    return scheduled(mixed).where(F.col("round").isNotNull())


def by_document(schedule: DataFrame) -> DataFrame:
    """A row per document, range-sorted by its first position, from the rows of ``scheduled``.

    Words of one source begin at one place only, so the place tells repeated rows apart.
    """
    own = ["doc_id", "source", "begins", "size", "source_size", "target"]
    taken = schedule.where(F.col("round").isNotNull()).groupBy(*own).agg(
        F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    left = schedule.where(F.col("round").isNull()).select(
        *own, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("double").alias("first_position"))
    return taken.unionByName(left).orderBy(F.col("first_position").asc_nulls_last(), "doc_id", "begins")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = saved(scheduled(mix(table(spark, sf_dir, "documents"))), "mix-schedule")
    return by_document(schedule).select("doc_id", "size", "source_size", "target", "taken", "first_position")


OP9_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS place
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
num AS (
  SELECT *, CAST(list_extract([{", ".join(map(str, WEIGHTS))}], CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1 AS BIGINT)) AS BIGINT) AS weight
  FROM src),
steps AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    {MOST} * coalesce(CAST(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS filled,
    CAST(sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM num WINDOW f AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source IS NULL, source)),
lev AS (SELECT *, CAST(total - filled AS DOUBLE) / rest AS level FROM steps),
tgt AS (
  SELECT source, source_size,
    least(CAST({MOST} * source_size AS DOUBLE), max(CASE WHEN level * weight <= {MOST} * source_size THEN level END) OVER () * weight) AS target,
    CAST({TILT} * (2 * CAST(weight - {min(WEIGHTS)} AS DOUBLE) / {max(WEIGHTS) - min(WEIGHTS)} - 1) AS DOUBLE) AS tilt
  FROM lev),
run AS (
  SELECT s.doc_id, s.size, t.*,
    coalesce(CAST(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS begins
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
goal AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS rounds FROM run),
took AS (
  SELECT *, rounds * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - rounds * source_size - begins)) AS taken FROM goal),
spot AS (
  SELECT *, least(CAST(1.0 AS DOUBLE), (begins + CAST(least(size, taken) AS DOUBLE) / 2) / greatest(CAST(1 AS DOUBLE), round(target))) AS share FROM took)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN 2 * share / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)) END AS first_position
FROM spot
"""
