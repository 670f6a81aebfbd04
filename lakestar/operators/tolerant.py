"""Natural-key joins that forgive misspelt texts and numbers that are a little off.

Two keys match if their texts, put together, differ in at most ``edits`` single-character
edits and their numbers by at most ``within``. Equi-joins and a sort do it, none of which compares
all keys:

1. Of the log only the distinct keys are matched, so a key with a third of all rows is one row. Of the catalogue's
   rows of one text and number only the smallest ids can win, so they are one row too.
   Keys that stand in the catalogue as they are meet it by equality.
2. The rest is joined on parts of the text and a bin of the number. A catalogue text is cut into ``edits + 1``
   segments; ``edits`` edits leave one of them whole, and it stands in the other text at most
   ``edits`` places away. So the catalogue is indexed by (length, number, segment), the log's keys look up
   the substrings that may be such a segment, and no match is lost. Bins are twice ``within`` wide, so a number
   looks into one bin or two. What is joined and verified are the distinct texts of a bin, however many numbers they have.
3. Keys and numbers of a pair's catalogue text stand in one order within their bin; each key takes the number before
   it and the one after it, so numbers that lie close cost a sort, not a pair each.
4. The best per key is kept, and the log meets the matches by equality of its whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.operators.skew import skewed_join

# Joins texts to one; it stands in no title or name.
BETWEEN = "\x1f"


def folded(columns: list[str]) -> Column:
    """Texts as one, in lower case, blanks trimmed and squeezed; NULL if one is."""
    parts = [F.regexp_replace(F.trim(F.lower(F.col(c))), r"\s+", " ") for c in columns]
    return F.concat(*[p if not i else F.concat(F.lit(BETWEEN), p) for i, p in enumerate(parts)])


def _segment(length: str, number: str, edits: int) -> tuple[str, str]:
    """Where a segment begins (from 0) and how long it is, as SQL; the longer ones come last."""
    base, longer = f"({length} DIV {edits + 1})", f"({length} % {edits + 1})"
    begin = f"({number} * {base} + greatest(0, {number} - ({edits + 1} - {longer})))"
    return begin, f"({base} + IF({number} >= {edits + 1} - {longer}, 1, 0))"


def segments(text: str, edits: int) -> Column:
    """The segments of a text: an array of (length, number, segment)."""
    begin, size = _segment(f"length({text})", "i", edits)
    return F.expr(f"""transform(sequence(0, {edits}), i -> struct(
        length({text}) AS length, i AS number, substring({text}, {begin} + 1, {size}) AS segment))""")


def lookups(text: str, edits: int) -> Column:
    """All (length, number, segment) under which a text within the edits may be indexed.

    An edit before a segment moves it by one, and what moves it has to be moved back after it: of the places around a segment's
    own only those are left that leave enough edits for the difference in length.
    """
    begin, size = _segment("m", "i", edits)
    low = f"greatest(0, {begin} - ({edits} - (length({text}) - m)) DIV 2)"
    high = f"least(length({text}) - {size}, {begin} + ({edits} + (length({text}) - m)) DIV 2)"
    return F.expr(f"""array_distinct(flatten(flatten(transform(
        sequence(greatest(0, length({text}) - {edits}), length({text}) + {edits}), m ->
            transform(sequence(0, {edits}), i ->
                IF({low} <= {high}, transform(sequence({low}, greatest({low}, {high})), p ->
                    struct(m AS length, i AS number, substring({text}, p + 1, {size}) AS segment)), array()))))))""")


def bins(number: Column, within: float) -> Column:
    """The bins in which numbers within reach may lie."""
    reach, width = within * (1 + 1e-9), 2 * within
    return F.sequence(F.floor((number - reach) / width), F.floor((number + reach) / width))


def matched_keys(
    keys: DataFrame, catalogue: DataFrame, texts: dict[str, str], number: tuple[str, str], ids: list[str], edits: int, within: float,
) -> DataFrame:
    """The best catalogue row of each key that has one: fewest edits, then the nearest number, then the smallest ids.

    ``texts`` and ``number`` name the log's and the catalogue's columns. NULL matches nothing.
    """
    if edits < 0 or within <= 0:
        raise ValueError("edits must not be negative, and within must be above 0")
    ours, theirs = number
    known = [*texts, ours]
    wanted = keys.select(*known).dropna("any").distinct().withColumn("__text", folded(list(texts)))
    side = (
        catalogue.select(folded(list(texts.values())).alias("__theirs"), F.col(theirs).alias("__number"), *ids)
        .dropna("any", subset=["__theirs", "__number"])
        .groupBy("__theirs", "__number").agg(F.min(F.struct(*ids)).alias("__ids")))
    exact = wanted.join(side, (F.col("__text") == F.col("__theirs")) & (F.col(ours) == F.col("__number"))).select(*known, "__ids.*")
    rest = wanted.join(exact.select(*known), known, "left_anti").withColumn("__bin", F.explode(bins(F.col(ours), within)))
    binned = side.withColumn("__bin", F.floor(F.col("__number") / (2 * within)))
    pairs = similar_texts(rest.select("__text", "__bin"), binned.select("__theirs", "__bin"), edits)
    asked = rest.join(pairs, ["__text", "__bin"]).select(*known, F.col(ours).alias("__at"), "__theirs", "__bin", "__edits")
    found = nearest(asked, binned).withColumn("__off", F.abs(F.col("__at") - F.col("__near.number"))).where(F.col("__off") <= within)
    best = found.groupBy(*known).agg(F.min(F.struct("__edits", "__off", "__near.ids")).alias("__best"))
    return exact.unionByName(best.select(*known, *[F.col(f"__best.ids.{i}").alias(i) for i in ids]))


def similar_texts(ours: DataFrame, theirs: DataFrame, edits: int) -> DataFrame:
    """``(__text, __bin, __theirs, __edits)``: the texts of one bin that differ in at most ``edits`` edits, each pair once."""
    sought = ours.distinct().select("*", F.explode(lookups("__text", edits)).alias("__part"))
    indexed = theirs.distinct().select("*", F.explode(segments("__theirs", edits)).alias("__part"))
    near = sought.join(indexed, ["__bin", "__part"]).withColumn("__edits", F.levenshtein("__text", "__theirs", edits))
    return near.where(F.col("__edits") >= 0).select("__text", "__bin", "__theirs", "__edits").distinct()


def nearest(asked: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows ``(__at, __theirs, __bin, ...)`` with ``__near``, the number of their text and bin next to ``__at`` and its ids.

    One row for the nearest number at or below, one for the nearest at or above, where there is one.
    """
    place = ["__theirs", "__bin"]
    rows = asked.select(*place, "__at", F.struct(*asked.columns).alias("__asked")).unionByName(
        numbers.select(*place, F.col("__number").alias("__at"), F.struct(F.col("__number").alias("number"), F.col("__ids").alias("ids")).alias("__near")),
        allowMissingColumns=True)
    # Rows of one number are peers, so a number is met from either side.
    below, above = (F.last("__near", ignorenulls=True).over(
        Window.partitionBy(*place).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
        for order in (F.asc("__at"), F.desc("__at")))
    sides = rows.select("__asked", F.array(below, above).alias("__both")).where(F.col("__asked").isNotNull())
    return sides.select("__asked.*", F.explode("__both").alias("__near")).where(F.col("__near").isNotNull())


def tolerant_key_join(
    log: DataFrame, catalogue: DataFrame, texts: dict[str, str], number: tuple[str, str], ids: list[str],
    edits: int = 2, within: float = 0.5, how: str = "left", salt: bool = False, hot_rows: int | None = None,
) -> DataFrame:
    """The log with the ids of the best match of each row: no row multiplies, and with ``how="left"`` none is lost."""
    matches = matched_keys(log, catalogue, texts, number, ids, edits, within)
    return skewed_join(log, matches, [*texts, number[0]], how, salt, hot_rows)
