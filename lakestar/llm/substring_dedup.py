"""Exact substring dedup by super-k-mers.

A window is ``window`` consecutive words of one text. Its minimiser is the ``mer`` words in it
with the smallest hash. Consecutive windows with one minimiser are a super-k-mer; they travel
as one packed string to the minimiser's bucket, where sorting finds windows that occur twice.

1. Minimisers of all texts, counted over the corpus. Equal windows have equal minimisers, so
   what has a minimiser of its own travels no further.
2. The rest is cut from the texts and dealt out by minimiser; each bucket sorts its windows.
   Windows that sort together are compared byte by byte.
3. Copies of a whole text are found by its digest beforehand: all their windows are repeated,
   and one of them stands for all in the search.
4. A bucket of over ``HOT`` super-k-mers is not put in one task: equal packed strings are
   counted first (a copied text shrinks to one string), then the windows of distinct strings
   are counted as rows, both combined before the shuffle.

Results: NULL text has no words. A row is known by id and text; an exact repeat of a row is
the same document and no second place. Rows without id count like others. Texts of fewer than
``window`` words lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import keyed, same_row, saved, table
from lakestar.llm.words import Words, grams, inside, lists, pieces, strings

WINDOW = 35
MER = 8
HOT = 2000
WHOLE = 2**31 - 1
RUNS = "doc_id long, text_key long, start int, stop int"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    n, have = len(values) - width + 1, 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:n], values[width - have:width - have + n])


def super_kmers(words: Words, window: int, mer: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows and minimiser of each super-k-mer."""
    hashed = words.hashes()
    ok = inside(words.first, window, len(hashed))
    if not ok.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    mers = grams(hashed, mer)
    # Hash and place in one number, so that ties go to the leftmost place; the high bits order.
    low = np.uint64((1 << 24) - 1)
    order = (mers & ~low) | (np.arange(len(mers), dtype=np.uint64) & low)
    least = sliding_min(order, window - mer + 1)
    at = np.flatnonzero(ok)
    owner = words.owner()[at]
    here = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (here[1:] != here[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    # Chunks hold under 2^24 words unless one text is longer: find the place next to its window.
    base = at[head] & ~int(low)
    place = base + (here[head] & low).astype(np.int64)
    place = np.where(place < at[head], place + int(low) + 1, place)
    return owner[head], at[head] - words.first[owner[head]], np.diff(np.append(head, len(at))), mers[place].view(np.int64)


def minimisers(window: int, mer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, words in pieces(batch.column("text")):
                owner, start, n, mini = super_kmers(words, window, mer)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(owner + a)), batch.column("text_key").take(pa.array(owner + a)),
                    pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(mini)],
                    ["doc_id", "text_key", "start", "n", "mini"])
    return run


def cut(window: int):
    """Packed strings of the super-k-mers listed beside each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("listed")
            for a, b, words in pieces(batch.column("text")):
                rows, packed, parts = [], [], []
                for i in range(a, b):
                    part = listed[i].values
                    start, n = part.field("start").to_numpy(), part.field("n").to_numpy()
                    first, last = words.first[i - a] + start, words.first[i - a] + start + n + window - 2
                    base = words.bounds[i - a]
                    own = bytes(words.data[base:words.bounds[i - a + 1]])
                    packed += [b" ".join(own[x - base:y - base].split()) for x, y in zip(words.start[first], words.stop[last], strict=True)]
                    parts.append(part)
                    rows += [i] * len(start)
                if not rows:
                    continue
                part, take = pa.concat_arrays(parts), pa.array(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(take), batch.column("text_key").take(take), part.field("start"),
                    part.field("mini"), part.field("hot"), pa.array(packed, pa.binary())],
                    ["doc_id", "text_key", "start", "mini", "hot", "packed"])
    return run


def repeated(packed: pa.Array, mini: np.ndarray, place: list, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and window of every window that occurs at two places or more in these whole buckets."""
    words = Words(*strings(packed))
    ok = inside(words.first, window, len(words.start))
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at
    owner = words.owner()[at]
    key = grams(words.hashes(), window)[at] ^ mini[owner].view(np.uint64)
    order = np.argsort(key, kind="stable")
    key, at, owner = key[order], at[order], owner[order]
    again = np.flatnonzero(key[1:] == key[:-1])
    raw, flag = words.data.tobytes(), np.zeros(len(at), bool)
    start, stop = words.start[at], words.stop[at + window - 1]
    odd = []
    for i in again.tolist():
        if raw[start[i]:stop[i]] != raw[start[i + 1]:stop[i + 1]]:
            odd.append(i)
        elif owner[i] != owner[i + 1] and place[owner[i]] == place[owner[i + 1]]:
            odd.append(i)  # the same place of a repeated row
        else:
            flag[i] = flag[i + 1] = True
    for key_of in {int(key[i]) for i in odd}:  # different windows under one hash, or repeated rows: by their words
        a, b = np.searchsorted(key, np.uint64(key_of)), np.searchsorted(key, np.uint64(key_of), side="right")
        seen: dict[bytes, set] = {}
        for i in range(a, b):
            seen.setdefault(raw[start[i]:stop[i]], set()).add((place[owner[i]], int(at[i] - words.first[owner[i]])))
        for i in range(a, b):
            flag[i] = len(seen[raw[start[i]:stop[i]]]) > 1
    return owner[flag], at[flag] - words.first[owner[flag]]


def as_runs(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of a row as row, first and last window."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    return row[head], at[head], at[np.append(head[1:], len(at)) - 1] if len(at) else at


def buckets(window: int):
    """Rows sorted by minimiser come in; repeated windows go out as word ranges. Holds one batch and one bucket."""
    def solve(rows: pa.Table) -> pa.RecordBatch:
        doc, key, start = rows["doc_id"].to_pylist(), rows["text_key"].to_pylist(), rows["start"].to_numpy()
        row, at = repeated(rows["packed"], rows["mini"].to_numpy(), list(zip(doc, key, start.tolist(), strict=True)), window)
        row, a, b = as_runs(row, at)
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([
            rows["doc_id"].combine_chunks().take(take), rows["text_key"].combine_chunks().take(take),
            pa.array(start[row] + a, pa.int32()), pa.array(start[row] + b + window, pa.int32())],
            ["doc_id", "text_key", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            mini = rows["mini"].to_numpy()
            whole = int(np.searchsorted(mini, mini[-1])) if len(mini) else 0
            if whole:
                yield solve(rows.slice(0, whole))
            held = rows.slice(whole)
        if held is not None and len(held):
            yield solve(held)
    return run


def single_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, words in pieces(batch.column("packed")):
                at = np.flatnonzero(inside(words.first, window, len(words.start)))
                owner, raw = words.owner()[at], words.data.tobytes()
                take = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays([
                    batch.column("string").take(take), batch.column("places").take(take),
                    pa.array(at - words.first[owner], pa.int32()),
                    pa.array([raw[x:y] for x, y in zip(words.start[at], words.stop[at + window - 1], strict=True)], pa.binary())],
                    ["string", "places", "at", "words"])
    return run


def hot_runs(hot: DataFrame, window: int) -> DataFrame:
    """Word ranges of repeated windows in buckets that are too large for a task: a row per text and packed string.

    A string that a text repeats is one row with all its places, so a line that fills texts stays small.
    """
    places = hot.groupBy("doc_id", "text_key", "packed").agg(F.collect_set("start").alias("starts"))
    strings_ = places.groupBy("packed").agg(F.sum(F.size("starts")).alias("places"))
    single = saved(
        strings_.select(F.md5("packed").alias("string"), "places", "packed")
        .mapInArrow(single_windows(window), "string string, places long, at int, words binary"), "dedup-windows")
    twice = saved(single.groupBy("words").agg(F.sum("places").alias("n")).where("n > 1").select("words"), "dedup-twice")
    found = saved(
        single.join(twice, "words").groupBy("string").agg(F.sort_array(F.collect_set("at")).alias("ats")), "dedup-found")

    def ranges(start: Column) -> Column:
        return F.transform("ats", lambda at: F.struct((start + at).alias("start"), (start + at + window).alias("stop")))

    return places.select("doc_id", "text_key", "starts", F.md5("packed").alias("string")).join(found, "string").select(
        "doc_id", "text_key", F.flatten(F.transform("starts", ranges)).alias("ranges"))


def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words outside the ranges, their digest and the counts."""
    for batch in batches:
        texts, ranges = batch.column("text"), batch.column("ranges")
        total, removed, digests, kept_texts = [], [], [], []
        for i in range(batch.num_rows):
            words = (texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b"").split()
            if ranges[i].is_valid:
                steps = np.zeros(len(words) + 1, np.int64)
                part = ranges[i].values
                np.add.at(steps, part.field("start").to_numpy(), 1)
                np.add.at(steps, np.minimum(part.field("stop").to_numpy(), len(words)), -1)
                gone = np.cumsum(steps)[:-1] > 0
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            else:
                kept = words
            text = b" ".join(kept)
            total.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(text).hexdigest())
            kept_texts.append(text.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def copies_of_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, stands)`` of the documents whose whole text another one has; one of each group stands for it."""
    rows = docs.select("doc_id", "text_key", F.md5("text").alias("digest")).where("digest IS NOT NULL").distinct()
    groups = saved(rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key")).alias("least")).where("n > 1"), "dedup-groups")
    return saved(
        rows.join(groups, "digest").select("doc_id", "text_key", F.struct("doc_id", "text_key").eqNullSafe(F.col("least")).alias("stands")),
        "dedup-copies")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot_rows: int = HOT) -> DataFrame:
    """``(doc_id, text_key, ranges)``: word ranges ``[start, stop)`` of every window that occurs elsewhere too.

    A text may have several rows. A range of a copied text ends at ``WHOLE``, behind its last word.
    """
    docs = keyed(docs)
    copied = copies_of_texts(docs)
    mini = saved(
        docs.mapInArrow(minimisers(window, mer), "doc_id long, text_key long, start int, n int, mini long"), "dedup-mini")
    others = copied.where("not stands")
    whole = mini.join(copied, same_row(mini, copied), "left_semi").select("doc_id", "text_key").distinct().select(
        "doc_id", "text_key", F.lit(0).alias("start"), F.lit(WHOLE).alias("stop"))
    mini = mini.join(others, same_row(mini, others), "left_anti")
    shared = saved(mini.groupBy("mini").agg(F.count("*").alias("rows")).where("rows > 1").select(
        "mini", (F.col("rows") > hot_rows).alias("hot")), "dedup-shared")
    listed = mini.join(shared, "mini").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "n", "mini", "hot")).alias("listed"))
    packed = saved(
        docs.join(listed, same_row(docs, listed)).select(docs["doc_id"], docs["text_key"], "text", "listed")
        .mapInArrow(cut(window), "doc_id long, text_key long, start int, mini long, hot boolean, packed binary"), "dedup-packed")
    cold = (
        packed.where("not hot").repartition("mini").sortWithinPartitions("mini")
        .mapInArrow(buckets(window), RUNS))
    rows = cold.unionByName(whole).select("doc_id", "text_key", F.array(F.struct("start", "stop")).alias("ranges"))
    return saved(rows.unionByName(hot_runs(packed.where("hot"), window)), "dedup-ranges")


def remove_repeated(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text: one row per input row."""
    ranges = repeated_ranges(docs, **options).groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("ranges")).alias("ranges"))
    docs = keyed(docs)
    return docs.join(ranges, same_row(docs, ranges), "left").select(docs["doc_id"], "text", "ranges").mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents")).drop("kept_text")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM d, unnest(generate_series(1, CAST(len(w) AS BIGINT) - 34)) AS t(i)),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, list(i) AS ats FROM win WHERE s IN (SELECT s FROM twice) GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM hit, unnest(ats) AS t(i), unnest(generate_series(i, i + 34)) AS u(p)),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS text, count(*) AS n
  FROM (SELECT doc_id, p, w[p] AS word FROM d, unnest(generate_series(1, CAST(len(w) AS BIGINT))) AS t(p)) e
  ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p
  GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""
