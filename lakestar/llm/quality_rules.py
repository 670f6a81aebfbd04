"""Quality rules as a short-circuit cascade.

A rule is a named test that rejects texts. Its cost (seconds a text) and its rejections are
measured on a bounded sample; rules then run in the order of rejections per second, each on the
texts that the ones before left. A text is kept if no rule rejects it, so the order changes the
time and never the verdict.

Base figures of every whole text come first, without any order: words, code points in words,
symbols, repeated lines, words in repeated three-word windows. Texts that fail on them are
dropped and meet no rule.

Results: NULL and empty texts have zeros and fail; rows that repeat get the same result each.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import WORD, hash_sample, table
from lakestar.llm.words import GAP, Words, grams, inside, mix, pieces

SAMPLE = 1000
MIN_WORDS = 50
SYMBOL, LETTER, CAPITAL, SMALL, HEAD = (np.zeros(256, np.int64) for _ in range(5))
SYMBOL[list(b"#*$%&|<>")] = 1
CAPITAL[65:91] = SMALL[97:123] = 1
LETTER[:] = CAPITAL | SMALL
LETTER[128:] = 1
HEAD[:] = ~GAP
HEAD[128:192] = 0  # bytes that continue a code point


class View:
    """Base figures of some texts, and their words for the rules."""

    def __init__(self, words: Words):
        self.words = words
        self.n_words = np.diff(words.first)
        self.word_chars = self.per_text(HEAD)
        self.n_symbols = self.per_text(SYMBOL)
        self.n_lines, self.n_dup_lines = self.line_counts()
        self.n_repeat_words = self.repeats()
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > 50 * self.n_words)

    def per_text(self, kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[self.words.data])])
        return total[self.words.bounds[1:]] - total[self.words.bounds[:-1]]

    def line_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them that equal an earlier line."""
        lines, again = np.zeros(len(self.n_words), np.int64), np.zeros(len(self.n_words), np.int64)
        raw, bounds = self.words.data.tobytes(), self.words.bounds.tolist()
        for i in np.flatnonzero(self.n_words).tolist():
            filled = [x for x in raw[bounds[i]:bounds[i + 1]].split(b"\n") if x and not x.isspace()]
            lines[i], again[i] = len(filled), len(filled) - len(set(filled))
        return lines, again

    def repeats(self) -> np.ndarray:
        hashed, owner = self.words.hashes(), self.words.owner()
        ok = inside(self.words.first, 3, len(hashed))
        at = np.flatnonzero(ok)
        key = mix(grams(hashed, 3)[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        hit = np.zeros(len(at), bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        covered = np.zeros(len(hashed), bool)
        for j in range(3):
            covered[at[hit] + j] = True
        total = np.concatenate([[0], np.cumsum(covered)])
        return total[self.words.first[1:]] - total[self.words.first[:-1]]

    def words_with(self, rows: np.ndarray, *tests: tuple[np.ndarray, bool]) -> np.ndarray:
        """How many words of each chosen text hold a byte of each kind (or hold none)."""
        first = self.words.first
        counts = first[rows + 1] - first[rows]
        at = np.repeat(first[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        ok = np.ones(len(at), bool)
        for kind, wanted in tests:
            total = np.concatenate([[0], np.cumsum(kind[self.words.data])])
            ok &= (total[self.words.stop[at]] > total[self.words.start[at]]) == wanted
        seen = np.concatenate([[0], np.cumsum(ok)])
        ends = np.cumsum(counts)
        return seen[ends] - seen[ends - counts]

    def top_word(self, rows: np.ndarray) -> np.ndarray:
        """How often the most frequent word of each chosen text occurs."""
        hashed, first = self.words.hashes(), self.words.first
        return np.array([np.unique(hashed[first[r]:first[r + 1]], return_counts=True)[1].max(initial=0) for r in rows.tolist()], np.int64)


@dataclass(frozen=True)
class Rule:
    """``rejects(view, rows)``: which of the chosen texts the rule rejects."""

    name: str
    rejects: Callable[[View, np.ndarray], np.ndarray]


RULES = (
    Rule("symbols", lambda v, r: 10 * v.n_symbols[r] > v.n_words[r]),
    Rule("word_length", lambda v, r: (v.word_chars[r] < 3 * v.n_words[r]) | (v.word_chars[r] > 12 * v.n_words[r])),
    Rule("dup_lines", lambda v, r: 100 * v.n_dup_lines[r] > 30 * v.n_lines[r]),
    Rule("letters", lambda v, r: 100 * v.words_with(r, (LETTER, True)) < 80 * v.n_words[r]),
    Rule("capitals", lambda v, r: 2 * v.words_with(r, (CAPITAL, True), (SMALL, False)) > v.n_words[r]),
    Rule("top_word", lambda v, r: 100 * v.top_word(r) > 30 * v.n_words[r]),
)


def measure(rules: tuple[Rule, ...]):
    """Seconds and rejections of every rule on the texts of the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in pieces(batch.column("text")):
                view = View(words)
                rows = np.flatnonzero(~view.base_failed)
                seconds, rejected = [], []
                for rule in rules:
                    began = time.perf_counter()
                    rejected.append(int(rule.rejects(view, rows).sum()))
                    seconds.append(time.perf_counter() - began)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.name for r in rules]), pa.array(seconds), pa.array(rejected, pa.int64())], ["rule", "seconds", "rejected"])
    return run


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second on the ``sample`` texts whose ids have the smallest hash."""
    chosen = hash_sample(docs.select("doc_id", "text"), ["doc_id"], sample, docs.count())
    found = chosen.select("text").mapInArrow(measure(rules), "rule string, seconds double, rejected long").groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()  # a row per rule
    gain = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in found}
    return sorted(rules, key=lambda r: -gain.get(r.name, 0.0))


def cascade(rules: list[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in pieces(batch.column("text")):
                view = View(words)
                kept = ~view.base_failed
                for rule in rules:
                    rows = np.flatnonzero(kept)
                    if not len(rows):
                        break
                    kept[rows[rule.rejects(view, rows)]] = False
                figures = (view.n_words, view.word_chars, view.n_symbols, view.n_dup_lines, view.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(x, pa.int64()) for x in figures), pa.array(view.base_failed), pa.array(kept)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])
    return run


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """A row per text: base figures, base_failed and kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(cascade(ordered(texts, rules, sample)), (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
ln AS (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line),
lines AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM ln GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM d, unnest(generate_series(1, CAST(len(w) AS BIGINT) - 2)) AS t(i)),
twice AS (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1),
cov AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT w.doc_id, i + j AS p FROM win w JOIN twice t ON w.doc_id = t.doc_id AND w.s = t.s, unnest([0, 1, 2]) AS u(j)) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS word FROM d),
kind AS (
  SELECT doc_id, count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS letters,
    count(*) FILTER (regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS capitals,
    CAST(sum(length(word)) AS BIGINT) AS chars
  FROM word GROUP BY doc_id),
top AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM word GROUP BY doc_id, word) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(chars, 0) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, letters, capitals, top.n AS top_n
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN kind USING (doc_id) LEFT JOIN top USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 3 * n_words OR word_chars > 12 * n_words OR 100 * n_dup_lines > 30 * n_lines
    OR 100 * letters < 80 * n_words OR 2 * capitals > n_words OR 100 * top_n > 30 * n_words) AS kept
FROM base
"""
