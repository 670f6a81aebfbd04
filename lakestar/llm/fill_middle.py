"""Fill-in-the-middle documents, assembled by a secondary sort.

A text is cut into units, each a word with the blanks before it (blanks at the end are a unit of their own). A keyed
hash of the id draws two cuts, which part it into prefix, middle and suffix, and its form: ``plain`` (the text as it is), ``psm``
(``<P>`` prefix ``<S>`` suffix ``<M>`` middle) or ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>`` middle).

1. Every text goes out as pieces of whole units, ``PIECE`` bytes or one unit at most, with its key and its place in the output.
2. Pieces are dealt out by document and sorted by place within partitions (the shuffle and sort of
   ``repartitionAndSortWithinPartitions``, on DataFrames). A task streams them: an incremental digest is
   all it holds of a document, however long that is.
3. For the restoration the output is parsed for its marks as it streams by, also where pieces
   meet; each run of bytes gets its place in the text. Rows of a document lie in one partition already, so they
   are sorted again without a shuffle, and the restored text streams into a second digest.

The key of a document is its id, its text's hash and its input partition: repeats (same id and text)
in one partition travel under one key, are read once and come out as often as they went in; those of other
partitions go to other tasks. Results: NULL text counts as empty; an empty text is plain with 0 units; a text with a
mark in it is plain; a NULL id draws as an empty id. No document, no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import keyed, table
from lakestar.llm.words import strings, Words

SEED = "42"
RATE = 50
SPM = 80
PIECE = 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Segments (0 prefix, 1 middle, 2 suffix) and the mark before each, in order of output.
ORDERS = {"plain": [(b"", 0)], "psm": [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)], "spm": [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}
KEY = "doc_id long, text_key long, part int"
FACTS = "form string, n long, prefix_chars long, middle_chars long"
BATCH_BYTES = 1 << 24


def draws(doc_id: int | None, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def runs(data: memoryview, ends: np.ndarray, first: int, last: int) -> Iterator[memoryview]:
    """Units ``first`` to ``last`` in runs of ``PIECE`` bytes (one unit at least); ``ends[i]`` is where unit i begins."""
    while first < last:
        to = max(first + 1, min(last, int(np.searchsorted(ends, ends[first] + PIECE, side="right")) - 1))
        yield data[ends[first]:ends[to]]
        first = to


def planned(doc_id: int | None, text: np.ndarray, words: Words, seed: str, rate: int, spm: int) -> tuple[tuple, list[bytes]]:
    """The facts of a document and its output in pieces."""
    ends = np.concatenate([[0], words.stop])
    if len(text) > ends[-1]:
        ends = np.append(ends, len(text))
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    data = text.tobytes()
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        form, parts, chars = "plain", [(0, n)], (None, None)
    else:
        form, parts = "spm" if h4 % 100 < spm else "psm", [(0, low), (low, high), (high, n)]
        chars = tuple(int(np.count_nonzero((text[ends[a]:ends[b]] & 0xC0) != 0x80)) for a, b in parts[:2])
    out = []
    for mark, segment in ORDERS[form]:
        rest = [bytes(x) for x in runs(memoryview(data), ends, *parts[segment])] or [b""]
        out += [mark + rest[0], *rest[1:]]
    return (form, n, *chars), out


def columns_of(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


KEY_KINDS = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("part", pa.int32())]
FACT_KINDS = [("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]


def cut(seed: str, rate: int, spm: int):
    """A row per piece of the output; each carries its document's facts."""
    kinds = [*KEY_KINDS, *FACT_KINDS, ("at", pa.int64()), ("piece", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = strings(batch.column("text"))
            rows, size = [], 0
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "part")), strict=True)):
                text = data[bounds[i]:bounds[i + 1]]
                facts, pieces = planned(key[0], text, Words(text, np.array([0, len(text)])), seed, rate, spm)
                rows += [(*key, *facts, at, piece) for at, piece in enumerate(pieces)]
                size += len(text)
                if size > BATCH_BYTES:
                    yield columns_of(rows, kinds)
                    rows, size = [], 0
            yield columns_of(rows, kinds)
    return run


class Output:
    """A document's output as it streams by: its digest, and which segment its bytes belong to."""

    def __init__(self, form: str):
        self.digest, self.copies = hashlib.sha256(), 0
        self.marks = [m for m, _ in ORDERS[form] if m]
        self.segments = [s for _, s in ORDERS[form]] if not self.marks else [0, *(s for _, s in ORDERS[form])]
        self.step, self.held, self.n = 0, b"", 0

    def add(self, piece: bytes, last: bool = False) -> list[tuple[int, int, bytes]]:
        """Runs ``(segment, number, bytes)`` that are certain by now; two bytes wait, for a mark may begin in them."""
        self.digest.update(piece)
        rest, out = self.held + piece, []
        while self.step < len(self.marks):
            place = rest.find(self.marks[self.step])
            if place < 0:
                break
            out.append((self.segments[self.step], rest[:place]))
            rest, self.step = rest[place + len(self.marks[self.step]):], self.step + 1
        wait = 0 if last or self.step == len(self.marks) else min(len(rest), 2)
        out.append((self.segments[self.step], rest[:len(rest) - wait]))
        self.held = rest[len(rest) - wait:]
        numbered = []
        for segment, run in out:
            if run:
                numbered.append((segment, self.n, run))
                self.n += 1
        return numbered


def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of output come in; runs with their place in the text go out, and a row per document before them (segment -1) with its facts and digest."""
    kinds = [*KEY_KINDS, *FACT_KINDS, ("copies", pa.int64()), ("output_sha256", pa.string()), ("segment", pa.int32()), ("at", pa.int64()), ("piece", pa.binary())]
    key, facts, seen, state = None, None, -1, None

    def closed() -> list[tuple]:
        if state is None:
            return []
        blank = (None,) * 4
        rest = [(*key, *blank, None, None, segment, at, run) for segment, at, run in state.add(b"", last=True)]
        return [*rest, (*key, *facts, state.copies, state.digest.hexdigest(), -1, 0, None)]

    for batch in batches:
        rows = []
        for doc_id, text_key, part, form, n, before, middle, at, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (doc_id, text_key, part) != key:
                rows += closed()
                key, facts, seen, state = (doc_id, text_key, part), (form, n, before, middle), -1, Output(form)
            state.copies += at == 0
            if at > seen:
                seen = at
                rows += [(*key, None, None, None, None, None, None, segment, i, run) for segment, i, run in state.add(piece)]
        yield columns_of(rows, kinds)
    yield columns_of(closed(), kinds)


def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of the text come in; a row per document goes out, as often as it came."""
    kinds = [*KEY_KINDS[:2], *FACT_KINDS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
    facts, digest = None, None

    def closed() -> list[tuple]:
        return [] if facts is None else [(*facts[:6], facts[7], digest.hexdigest())] * facts[6]

    for batch in batches:
        rows = []
        for doc_id, text_key, _, form, n, before, middle, copies, sha, segment, _, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment < 0:
                rows += closed()
                facts, digest = (doc_id, text_key, form, n, before, middle, copies, sha), hashlib.sha256()
            else:
                digest.update(run)
        yield columns_of(rows, kinds)
    yield columns_of(closed(), kinds)


def assembled(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The output: ``(doc_id, text_key, part, form, n, prefix_chars, middle_chars, at, piece)``, each document's pieces in one partition and in order."""
    pieces = keyed(docs).withColumn("part", F.spark_partition_id()).mapInArrow(cut(seed, rate, spm), f"{KEY}, {FACTS}, at long, piece binary")
    return pieces.repartition("doc_id", "text_key", "part").sortWithinPartitions("doc_id", "text_key", "part", "at")


def digests(pieces: DataFrame) -> DataFrame:
    """doc_id, text_key, form, n, prefix_chars, middle_chars, and the digests of the output and of the text rebuilt from it: a row per document."""
    placed = pieces.mapInArrow(parsed, f"{KEY}, {FACTS}, copies long, output_sha256 string, segment int, at long, piece binary")
    return placed.sortWithinPartitions("doc_id", "text_key", "part", "segment", "at").mapInArrow(
        restored, f"doc_id long, text_key long, {FACTS}, output_sha256 string, restored_sha256 string")


def texts(pieces: DataFrame) -> DataFrame:
    """doc_id, text_key, form and the output as one text: a row per document. Holds one document at a time."""
    kinds = [*KEY_KINDS[:2], ("form", pa.string()), ("output", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, form, copies, held = None, None, 0, []

        def closed() -> Iterator[pa.RecordBatch]:
            for _ in range(copies):
                yield columns_of([(*key[:2], form, b"".join(held).decode())], kinds)

        for batch in batches:
            names = ("doc_id", "text_key", "part", "form", "at", "piece")
            for doc_id, text_key, part, kind, at, piece in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (doc_id, text_key, part) != key:
                    yield from closed()
                    key, form, copies, held = (doc_id, text_key, part), kind, 0, []
                copies += at == 0
                if at == len(held):
                    held.append(piece)
        yield from closed()
    return pieces.mapInArrow(run, "doc_id long, text_key long, form string, output string")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(assembled(table(spark, sf_dir, "documents"))).drop("text_key")


OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
k AS (SELECT *, CAST(len(units) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || h[i:i + 7] AS BIGINT)) AS r FROM d),
c AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS low, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= {RATE} THEN 'plain'
      WHEN r[4] % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM k),
s AS (
  SELECT *, array_to_string(units[1:low], '') AS pre, array_to_string(units[low + 1:high], '') AS mid, array_to_string(units[high + 1:n], '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM s
"""
