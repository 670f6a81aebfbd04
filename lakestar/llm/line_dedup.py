"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its token count and its first ``LEAD`` tokens; a token with a digit is a
variable field (``<*>``). A path is busy if at least ``MIN_DOCS`` lines, of two forms or more, go down it (each form once a
text). A line that stands under no busy path of its own goes to a wildcard child: the busiest path that has one of its leading
tokens replaced by ``<*>``. In a leaf, a token that stands at its place in fewer than ``MIN_DOCS`` lines is a
variable field too, and a field is never constant. What remains is the line's template, if at least ``CONSTANT`` of
its tokens are constant. All other lines, those of up to ``SHORT`` tokens and those outside busy leaves, are their own template.
The tree is deep enough that plain prose seldom meets in a leaf, however much of it there is.

A template is a candidate if it stands in enough different texts: ``MIN_DOCS`` for lines of up to ``MIN_DOCS`` tokens, fewer for
longer ones (``REPEATED`` tokens in all), two from 50 tokens on. Copied documents repeat lines too, but they are left to
the document-level operators, so a text has no vote on a line that it may have been copied with: if at least
``COPIED`` of its tokens lie in lines about as common as the line or more (by powers of two; a line is as common as its first or
last ``EDGE`` tokens are, fields masked, so that one changed word does not hide a copy). A candidate with enough votes recurs, and its lines
are dropped from every text.

All of it is DataFrame functions. The lines are tokenised once and saved; only hashes and counts are shuffled, and the tokens of
busy leaves. Counts are combined before they are shuffled, so a line in a third of all texts is a row a task. Exact copies count as
one text. Results: NULL text stays NULL with 0 lines; blank lines are never dropped and no neighbours of
anything; lines that differ in blanks only are alike; rows with one text get the same result each. No document, no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import WORD, keyed, saved, settled, table

LEAD = 6
SHORT = 3
MIN_DOCS = 10
REPEATED = 100
CONSTANT = 0.7
COPIED = 0.75
EDGE = 8
FIELD = "<*>"


def needed(n: Column) -> Column:
    """Texts that a line of n tokens has to stand in."""
    return F.greatest(F.lit(2), F.least(F.lit(MIN_DOCS), F.ceil(REPEATED / n))).cast("long")


def masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), FIELD).otherwise(token)


def tokens_of(line: Column) -> Column:
    """Tokens of a line without line breaks; the common case takes no look at each token."""
    blank = line
    for sign in "\t\x0b\x0c\r":
        blank = F.replace(blank, F.lit(sign), F.lit(" "))
    plain = F.when(line.contains("\t") | line.contains("\x0b") | line.contains("\x0c") | line.contains("\r"), blank).otherwise(line)
    parts = F.split(plain, " ", -1)
    odd = (line == "") | plain.contains("  ") | plain.startswith(" ") | plain.endswith(" ")
    return F.when(odd, F.filter(parts, lambda t: t != "")).otherwise(parts)


def level(count: Column) -> Column:
    """The power of two that a count reaches."""
    return F.floor(F.log2(count.cast("double")) + 1e-9).cast("int")


def lines_of(docs: DataFrame) -> DataFrame:
    """A row per line that has tokens: its place, token count, hash of its tokens, of its leading, first and last ones, and the line."""
    rows = docs.where("text IS NOT NULL").select("text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    tokens = rows.withColumn("tokens", tokens_of(F.col("line"))).withColumn("n", F.size("tokens")).where("n > 0").withColumn(
        "fields", F.when(F.col("line").rlike("[0-9]"), F.transform("tokens", masked)).otherwise(F.col("tokens")))
    lead = [F.when(F.col("n") > SHORT, F.xxhash64(F.get("fields", F.lit(i)))).alias(f"lead{i}") for i in range(LEAD)]
    return tokens.select(
        "text_key", "pos", "n", F.xxhash64("tokens").alias("form"), *lead, F.xxhash64(F.slice("fields", 1, EDGE)).alias("head"),
        F.xxhash64(F.slice("fields", F.greatest(F.lit(1), F.col("n") - EDGE + 1), F.lit(EDGE))).alias("tail"),
        F.when(F.col("n") > SHORT, F.col("line")).alias("line"))


def paths(n: Column, lead: list[Column]) -> Column:
    """The path of a line, then those with one leading token replaced."""
    any_token = F.xxhash64(F.lit(FIELD))
    return F.array(*(F.xxhash64(n, *(any_token if i == j else c for i, c in enumerate(lead))) for j in (None, *range(len(lead)))))


def leaves(lines: DataFrame) -> DataFrame:
    """``(form, n, texts, leaf)`` for the forms that stand in a busy leaf."""
    lead = [f"lead{i}" for i in range(LEAD)]
    forms = saved(
        lines.where(F.col("n") > SHORT).select("form", "text_key", "n", *lead).dropDuplicates(["form", "text_key"])
        .groupBy("form").agg(F.count("*").alias("texts"), F.first("n").alias("n"), *(F.first(c).alias(c) for c in lead)), "lines-forms")
    # A leading token with a digit is a field already; its path and that wildcard path are one.
    ways = forms.select("form", "n", "texts", F.posexplode(F.array_distinct(paths(F.col("n"), [F.col(c) for c in lead]))).alias("way", "leaf"))
    busy = ways.groupBy("leaf").agg(F.sum("texts").alias("weight"), F.count("*").alias("forms")).where(
        (F.col("weight") >= MIN_DOCS) & (F.col("forms") > 1)).select("leaf", "weight")
    order = F.struct(F.col("way") > 0, -F.col("weight"), F.col("way"), F.col("leaf").alias("leaf"))
    return saved(
        ways.join(saved(busy, "lines-busy"), "leaf").groupBy("form").agg(F.min(order).alias("best"), F.first("n").alias("n"), F.first("texts").alias("texts"))
        .select("form", "n", "texts", F.col("best.leaf").alias("leaf")), "lines-leaves")


def templates(lines: DataFrame) -> DataFrame:
    """``(form, template)`` for the lines whose variable fields are generalised."""
    words = lines.where(F.col("n") > SHORT).select("form", "line").join(leaves(lines), "form").dropDuplicates(["form"])
    tokens = saved(words.select("form", "leaf", "n", "texts", F.posexplode(F.transform(tokens_of(F.col("line")), masked)).alias("at", "token")), "lines-tokens")
    common = tokens.where(F.col("token") != FIELD).groupBy("leaf", "at", "token").agg(F.sum("texts").alias("often")).where(
        F.col("often") >= MIN_DOCS).select("leaf", "at", "token")
    constants = tokens.join(common, ["leaf", "at", "token"]).groupBy("form", "leaf", "n").agg(
        F.count("*").alias("constants"), F.bit_xor(F.xxhash64("at", "token")).alias("fields"))
    return saved(
        constants.where(F.col("constants") >= CONSTANT * F.col("n")).select("form", F.xxhash64("leaf", "fields").alias("template")), "lines-templates")


def votes(lines: DataFrame) -> DataFrame:
    """``(template)`` of the candidates that enough texts vote for; lines are ``(text_key, n, template, head, tail)``."""
    stands = lines.groupBy("template", "text_key").agg(F.first("n").alias("n"))
    candidates = saved(
        stands.groupBy("template").agg(F.count("*").alias("texts"), F.first("n").alias("n")).where(F.col("texts") >= needed(F.col("n"))), "lines-candidates")
    held = saved(stands.join(candidates.select("template", "texts"), "template").select("template", "text_key", "n", level(F.col("texts")).alias("level")), "lines-held")
    near = saved(lines.join(held.select("text_key").distinct(), "text_key", "left_semi").select("text_key", "n", "head", "tail"), "lines-near")
    ends = near.select("text_key", "n", "head", "tail", F.explode(F.array(
        F.struct(F.lit(0).alias("end"), F.col("head").alias("key")), F.struct(F.lit(1).alias("end"), F.col("tail").alias("key")))).alias("k")).select(
        "text_key", "n", "head", "tail", "k.*")
    often = ends.select("end", "key", "text_key").distinct().groupBy("end", "key").agg(F.count("*").alias("often")).where("often > 1")
    often = saved(often, "lines-edges")
    heads, tails = (often.where(F.col("end") == i).select(F.col("key").alias(c), F.col("often").alias(f"often_{c}")) for i, c in enumerate(("head", "tail")))
    common = near.join(heads, "head", "left").join(tails, "tail", "left").withColumn("often", F.greatest("often_head", "often_tail"))
    shares = common.groupBy("text_key", level(F.coalesce("often", F.lit(1))).alias("common")).agg(F.sum("n").alias("size"))
    shares = saved(shares, "lines-shares")
    beside = F.sum(F.when((F.col("common") > 0) & (F.col("common") >= F.col("level") - 1), F.col("size")).otherwise(0))
    voting = held.join(shares, "text_key").groupBy("template", "text_key").agg(
        F.first("n").alias("n"), beside.alias("beside"), F.sum("size").alias("all")).where(F.col("beside") < COPIED * F.col("all"))
    return saved(voting.groupBy("template").agg(F.count("*").alias("votes"), F.first("n").alias("n")).where(
        F.col("votes") >= needed(F.col("n"))).select("template"), "lines-recurring")


def recurring_lines(docs: DataFrame) -> DataFrame:
    """``(text_key, gone)``: the places of the lines to drop, for the texts that have any."""
    lines = saved(lines_of(keyed(docs)), "lines")
    known = lines.select("text_key", "pos", "n", "form", "head", "tail").join(templates(lines), "form", "left").select(
        "text_key", "pos", "n", "head", "tail", F.coalesce("template", "form").alias("template"))
    known = saved(known, "lines-known")
    return known.join(votes(known), "template", "left_semi").groupBy("text_key").agg(F.collect_set("pos").alias("gone"))


def drop_recurring_lines(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped and kept_text (and ``doc``, see ``keyed``): a row per input row."""
    gone = settled(docs.sparkSession, lambda: recurring_lines(docs), "lines-gone")
    docs = keyed(docs, carry)
    others = ["doc"] if carry else []
    # The same join at every size: a few texts with such lines would be broadcast, many not.
    joined = docs.join(gone.hint("merge"), "text_key", "left").select("doc_id", "text_key", "text", "gone", *others)
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("gone", i)), "\n")
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return joined.select(
        "doc_id", "text_key", F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"), *others)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(table(spark, sf_dir, "documents")).drop("text_key")


OP8_SQL = rf"""
WITH texts AS (SELECT text, row_number() OVER (ORDER BY text) AS tid FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
split AS (
  SELECT tid, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS pos FROM texts),
ln AS (SELECT tid, pos, regexp_extract_all(line, '{WORD}') AS w FROM split WHERE regexp_matches(line, '{WORD}')),
form AS (
  SELECT w, len(w) AS n, count(DISTINCT tid) AS texts, list_transform(w, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS m
  FROM ln GROUP BY w),
way AS (
  SELECT w, texts, k, list_transform(m[1:{LEAD}], lambda x, i: CASE WHEN i = k THEN '{FIELD}' ELSE x END) AS p, n
  FROM form, unnest(range({LEAD + 1})) AS u(k) WHERE n > {SHORT}),
own AS (SELECT w, n, p, min(k) AS k, any_value(texts) AS texts FROM way GROUP BY w, n, p),
busy AS (SELECT n, p, sum(texts) AS weight FROM own GROUP BY n, p HAVING sum(texts) >= {MIN_DOCS} AND count(*) > 1),
pick AS (
  SELECT w, n, p FROM own JOIN busy USING (n, p)
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY k > 0, weight DESC, k) = 1),
tk AS (
  SELECT pick.p, pick.n, w, texts, unnest(m) AS token, generate_subscripts(m, 1) AS nth FROM pick JOIN form USING (w)),
fixed AS (SELECT p, n, nth, token FROM tk WHERE token <> '{FIELD}' GROUP BY ALL HAVING sum(texts) >= {MIN_DOCS}),
tpl AS (
  SELECT tk.w, list(CASE WHEN f.token IS NULL THEN '{FIELD}' ELSE f.token END ORDER BY tk.nth) AS fields, tk.p
  FROM tk LEFT JOIN fixed f ON f.p = tk.p AND f.n = tk.n AND f.nth = tk.nth AND f.token = tk.token
  GROUP BY tk.w, tk.p HAVING count(f.token) >= {CONSTANT} * count(*)),
known AS (
  SELECT tid, pos, len(ln.w) AS n, CASE WHEN tpl.w IS NULL THEN ['own'] || ln.w ELSE ['tree'] || tpl.p || tpl.fields END AS template,
    array_to_string(form.m[1:{EDGE}], ' ') AS head, array_to_string(form.m[greatest(1, len(ln.w) - {EDGE - 1}):], ' ') AS tail
  FROM ln JOIN form ON ln.w = form.w LEFT JOIN tpl ON ln.w = tpl.w),
cand AS (
  SELECT template, n, count(DISTINCT tid) AS texts, greatest(2, least({MIN_DOCS}, ceil({REPEATED} / n))) AS need
  FROM known GROUP BY template, n HAVING count(DISTINCT tid) >= greatest(2, least({MIN_DOCS}, ceil({REPEATED} / n)))),
near AS (SELECT * FROM known WHERE tid IN (SELECT tid FROM known JOIN cand USING (template))),
h AS (SELECT head, count(DISTINCT tid) AS often FROM near GROUP BY head),
t AS (SELECT tail, count(DISTINCT tid) AS often FROM near GROUP BY tail),
common AS (SELECT near.*, greatest(h.often, t.often) AS often FROM near JOIN h USING (head) JOIN t USING (tail)),
held AS (SELECT DISTINCT tid, template, cand.n, texts, need FROM known JOIN cand USING (template)),
vote AS (
  SELECT held.template, held.tid, any_value(need) AS need
  FROM held JOIN common c ON c.tid = held.tid
  GROUP BY held.template, held.tid
  HAVING sum(CASE WHEN c.often > 1 AND floor(log2(c.often) + 1e-9) >= floor(log2(held.texts) + 1e-9) - 1 THEN c.n ELSE 0 END) < {COPIED} * sum(c.n)),
rec AS (SELECT template FROM vote GROUP BY template HAVING count(*) >= max(need)),
gone AS (SELECT DISTINCT tid, pos FROM known WHERE template IN (SELECT template FROM rec)),
kept AS (
  SELECT s.tid, count(*) AS n_lines, count(g.pos) AS n_dropped, string_agg(CASE WHEN g.pos IS NULL THEN s.line END, chr(10) ORDER BY s.pos) AS kept_text
  FROM split s LEFT JOIN gone g ON s.tid = g.tid AND s.pos = g.pos GROUP BY s.tid)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept_text, '') END AS kept_text
FROM documents d LEFT JOIN texts ON d.text = texts.text LEFT JOIN kept USING (tid)
"""
