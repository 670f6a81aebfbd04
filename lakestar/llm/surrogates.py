"""Surrogates for personal data: keyed, of the same type, gender, script and format.

Entities are found by pattern: e-mail and IP addresses, phone, card, bank and identity numbers, access
keys and tokens, and names behind a form of address. A surrogate is drawn for the entity's
canonical form (digits of a number, lower-case address or token), so all its spellings, in all texts, get
one surrogate, which is written in the format of each spelling: digits stay digits, capitals
capitals, separators stay where they are. Given and family names are drawn by themselves, from lists of
the same gender and script; a name found behind a form of address is replaced in the rest of its text too. Draws are keyed digests: without the key they can't be undone or repeated.

Numbers keep right check digits: cards, and bank numbers by their remainder. Names of over 64 letters, local parts of over 64 signs,
dates of birth and street addresses are left. Patterns repeat within bounds or possessively, so a text of one long run takes
linear time and no stack.

Collision checks: a surrogate that another entity of its type has, or that is itself an entity
of the corpus, is drawn again with the next attempt number, for one of the colliding entities all but the
smallest, until none collides. So different entities stay different. A draw that collides depends on what else is in
the corpus: over a grown corpus an entity may get another surrogate.

All of it is DataFrame functions. Texts without a digit, ``@`` or form of address pass without a
shuffle; equal entities are combined before theirs. Results: NULL and empty texts stay; rows
that repeat get the same result each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.shared import keyed, once, same_row, saved, table

KEY = "surrogate-key"
ROUNDS = 50

MALE = r"(?:Mr|Mister|Sir|Herrn?|Monsieur|Señor|Sr|Г-н|Господин)\b\.?"
FEMALE = r"(?:Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Г-жа|Госпожа)\b\.?"
# A possessive ending is not of the name, nor is a run of over 64 letters one. Possessive repeats keep the matcher from recursing.
NAME_WORD = r"\p{Lu}(?:\p{L}{1,63}+(?:['-](?!s\b)\p{L}{1,64}+){0,4}+|(?:['-](?!s\b)\p{L}{1,64}+){1,4}+)(?!\p{L})"
NAME = rf"{NAME_WORD}(?:[ \t]+{NAME_WORD})?"
PERSON = ("male", "female", "family")
# Patterns by type, first match first.
TYPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,63}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)",
    "ipv6": r"(?<![\w:.])(?=[A-Fa-f:]{0,35}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "key": r"\b(?:A[KS]IA[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{36,255}|AIza[0-9A-Za-z_-]{35}|sk[-_][A-Za-z0-9_-]{20,200}|xox[abprs]-[0-9A-Za-z-]{10,200})\b",
    "token": r"\b(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"\b\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}\b|\(\d{3}\) ?\d{3}-\d{4}\b|\b\d{3}[.-]\d{3}[.-]\d{4}\b|\b0[1-9]\d{1,3}[ /-]\d{3,4}[ -]?\d{2,5}\b",
    "male": rf"\b{MALE}[ \t]+{NAME}",
    "female": rf"\b{FEMALE}[ \t]+{NAME}",
}
PATTERN = "|".join(TYPES.values())
MAYBE = rf"[0-9@]|\b{MALE}[ \t]+\p{{Lu}}|\b{FEMALE}[ \t]+\p{{Lu}}"
# Given and family names by script and gender.
NAMES = {
    ("latin", "male"): ["Adrian", "Bruno", "Carl", "David", "Emil", "Frank", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noah", "Oscar", "Paul"],
    ("latin", "female"): ["Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olivia", "Paula"],
    ("cyrillic", "male"): ["Алексей", "Борис", "Виктор", "Григорий", "Дмитрий", "Егор", "Иван", "Кирилл", "Леонид", "Максим", "Николай", "Олег", "Павел", "Роман", "Сергей", "Тимур"],
    ("cyrillic", "female"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Лариса", "Мария", "Надежда", "Ольга", "Полина", "Раиса", "Софья", "Татьяна"],
    ("greek", "male"): ["Αλέξης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Θανάσης", "Ιάσονας", "Κώστας", "Λουκάς", "Μιχάλης", "Νίκος", "Ορέστης", "Πέτρος", "Σπύρος", "Τάσος", "Φώτης"],
    ("greek", "female"): ["Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Θεοδώρα", "Ιωάννα", "Κατερίνα", "Λυδία", "Μαρία", "Νεφέλη", "Ολυμπία", "Σοφία", "Χριστίνα"],
}
SYLLABLES = {
    "latin": ["al", "ber", "cor", "dan", "el", "far", "gan", "hol", "in", "jor", "kel", "lan", "mor", "nis", "ol", "per"],
    "cyrillic": ["ал", "бер", "вор", "ган", "дел", "жар", "зан", "кол", "лин", "мор", "нис", "ор", "пер", "ран", "сел", "тор"],
    "greek": ["αλ", "βερ", "γαν", "δελ", "ζαν", "θελ", "ιν", "κολ", "λαν", "μορ", "νικ", "ορ", "περ", "ραν", "σελ", "τορ"],
}
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}


def type_of(found: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(TYPES.items()):
        out = F.when(found.rlike(rf"^(?:{pattern})$"), kind).otherwise(out)
    return out


def bare(found: Column, kind: Column) -> Column:
    """What is replaced: a name without its form of address, anything else whole."""
    return F.when(kind.isin("male", "female"), F.regexp_replace(found, rf"^(?:{MALE}|{FEMALE})[ \t]+", "")).otherwise(found)


def canonical(value: Column, kind: Column) -> Column:
    return F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, "[^0-9]", "")).when(
        kind.isin("email", "token", "ipv6"), F.lower(value)).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(
        kind.isin(*PERSON), F.lower(F.regexp_replace(value, r"[ \t]+", " "))).otherwise(value)


def digest_numbers(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """64 keyed numbers of 0 to 255."""
    drawn = F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 512)
    numbers = lambda x: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(x, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    return once(drawn, numbers)


def signs(numbers: Column, value: Column, kept: Column, small: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Each digit and letter replaced by one of its class, from ``kept`` characters on; small letters by one of ``small``."""
    def sign(c: Column, i: Column) -> Column:
        n = F.get(numbers, i % 64) + i * 7
        pick = lambda letters: F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
        return F.when(i < kept, c).when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick(small)).when(
            c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), sign), "")


def luhn(digits: Column) -> Column:
    """The sum that a card number's digits leave modulo 10."""
    def total(back: Column) -> Column:
        def add(sum_: Column, i: Column) -> Column:
            d = F.get(back, i).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
            return sum_ + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), F.size(back) - 1), F.lit(0), add) % 10

    return once(F.split(F.reverse(digits), ""), total)


def remainder(iban: Column) -> Column:
    """What the number leaves modulo 97 with its first four signs behind it and letters as 10 to 35; 1 if its check digits are right."""
    behind = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    return F.aggregate(F.split(behind, ""), F.lit(0), lambda sum_, c: F.when(
        c.rlike("[A-Z]"), (sum_ * 100 + F.ascii(c) - 55) % 97).otherwise((sum_ * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97))


def with_check_digits(iban: Column) -> Column:
    country, rest = F.substring(iban, 1, 2), F.substring(iban, F.lit(5), F.length(iban))
    return F.concat(country, F.lpad((98 - remainder(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0"), rest)


def draw(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """A surrogate of the canonical form."""
    return once(digest_numbers(kind, value, attempt, key), lambda numbers: drawn_from(numbers, kind, value, attempt))


def checked(card: Column) -> Column:
    """A card number with a last digit that makes its sum right."""
    front = F.substring(card, F.lit(1), F.length(card) - 1)
    return F.concat(front, ((10 - luhn(F.concat(front, F.lit("0")))) % 10).cast("string"))


def drawn_from(numbers: Column, kind: Column, value: Column, attempt: Column) -> Column:
    at = lambda i, n: F.get(numbers, F.lit(i)) % n
    ip = F.concat_ws(".", *((F.get(numbers, F.lit(i)) % 254 + 1).cast("string") for i in range(4)))
    plain = signs(numbers, value, F.lit(0))
    card = signs(numbers, value, F.lit(1))
    card = F.when(luhn(value) == 0, once(card, checked)).otherwise(card)
    iban = signs(numbers, value, F.lit(2))
    iban = F.when(remainder(value) == 1, once(iban, with_check_digits)).otherwise(iban)
    host = F.length(F.substring_index(value, ".", -1))
    email = F.concat(signs(numbers, F.substring(value, F.lit(1), F.length(value) - host), F.lit(0)), F.substring_index(value, ".", -1))
    def part(i: Column, choices: list[str]) -> Column:
        return F.element_at(F.array(*(F.lit(c.lower()) for c in choices)), F.get(numbers, i) % 16 + 1)

    def given(script: str, gender: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.least(attempt, F.lit(7))), lambda i: part(i, NAMES[script, gender])), "-")

    def person(script: str) -> Column:
        family = F.array_join(F.transform(F.sequence(F.lit(1), 3 + F.least(attempt, F.lit(7))), lambda i: part(i, SYLLABLES[script])), "")
        return F.when(kind == "male", given(script, "male")).when(kind == "female", given(script, "female")).otherwise(family)

    name = person("latin")
    for script, letters in SCRIPTS.items():
        name = F.when(value.rlike(letters), person(script)).otherwise(name)
    return (
        F.when(kind == "ip", ip).when(kind == "email", email).when(kind == "card", card).when(kind == "key", signs(numbers, value, F.lit(4)))
        .when(kind.isin("token", "ipv6"), signs(numbers, value, F.lit(0), "abcdef"))
        .when(kind == "iban", iban).when(kind == "phone", signs(numbers, value, F.lit(1)))
        .when(kind.isin(*PERSON), name).otherwise(plain))


def formatted(value: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate written like ``value``."""
    spread = lambda keep: F.array_join(F.transform(
        F.split(value, ""), lambda c, i: F.when(c.rlike(keep), F.substring(
            surrogate, F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), f"(?!{keep}).", "")), F.lit(1))).otherwise(c)), "")
    capital = F.when(value == F.upper(value), F.upper(surrogate)).when(
        F.substring(value, 1, 1).rlike("[A-Z]"), F.initcap(surrogate)).otherwise(surrogate)
    titled = F.when((value == F.upper(value)) & (F.length(value) > 1), F.upper(surrogate)).otherwise(
        F.array_join(F.transform(F.split(surrogate, "-"), lambda x: F.initcap(x)), "-"))
    cased = F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(
        F.substring(value, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    return F.when(kind.isin("token", "ipv6"), cased).when(kind.isin("card", "ssn", "phone"), spread("[0-9]")).when(kind == "iban", spread("[A-Z0-9]")).when(
        kind == "email", capital).when(kind.isin(*PERSON), titled).otherwise(surrogate)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, value, surrogate)`` for distinct ``(kind, value)``: no two alike in a type, none a real entity."""
    entities = saved(entities.distinct(), "pii-entities")
    real = entities.select("kind", F.col("value").alias("surrogate"))
    drawn = saved(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw(F.col("kind"), F.col("value"), F.lit(0), key)), "pii-drawn")
    for _ in range(ROUNDS):
        first = drawn.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min("value").alias("keeps"))
        twice = drawn.join(first.where("n > 1"), ["kind", "surrogate"]).where("value != keeps").select("kind", "value")
        taken = drawn.join(real, ["kind", "surrogate"], "left_semi").select("kind", "value")
        again = saved(twice.union(taken).distinct(), "pii-again")
        if not again.limit(1).count():
            return drawn.select("kind", "value", "surrogate")
        redrawn = drawn.join(again, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        redrawn = redrawn.withColumn("surrogate", draw(F.col("kind"), F.col("value"), F.col("attempt"), key))
        drawn = saved(drawn.join(again, ["kind", "value"], "left_anti").unionByName(redrawn), "pii-drawn")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} draws; a type has too few of them")


def is_name(kind: Column) -> Column:
    return kind.isin("male", "female")


def entities_of(found: Column) -> Column:
    """Per entity: found, spelled, and the one or two parts (kind, value, spelled) that get surrogates.

    A name of two words is a given and a family name. One word is a family name, unless the text has
    it as a given name only.
    """
    typed = F.transform(found, lambda f: F.struct(f.alias("found"), type_of(f).alias("kind")))
    named_ = F.transform(typed, lambda e: F.struct(
        e["found"].alias("found"), e["kind"].alias("kind"), bare(e["found"], e["kind"]).alias("spelled"),
        canonical(bare(e["found"], e["kind"]), e["kind"]).alias("value")))

    def parts(all_: Column) -> Column:
        whole = F.filter(all_, lambda e: is_name(e["kind"]) & F.contains(e["value"], F.lit(" ")))
        words = lambda i: F.array_distinct(F.transform(whole, lambda e: F.substring_index(e["value"], " ", i)))

        def split_up(e: Column, given: Column, family: Column) -> Column:
            def part(kind: Column, i: int) -> Column:
                return F.struct(kind.alias("kind"), F.substring_index(e["value"], " ", i).alias("value"),
                                F.regexp_extract(e["spelled"], r"^[^ \t]+" if i > 0 else r"[^ \t]+$", 0).alias("spelled"))

            alone = F.when(F.array_contains(given, e["value"]) & ~F.array_contains(family, e["value"]), e["kind"]).otherwise(F.lit("family"))
            same = F.struct(e["kind"].alias("kind"), e["value"].alias("value"), e["spelled"].alias("spelled"))
            return F.when(~is_name(e["kind"]) | e["kind"].isNull(), F.array(same)).when(
                F.contains(e["value"], F.lit(" ")), F.array(part(e["kind"], 1), part(F.lit("family"), -1))).otherwise(
                F.array(part(alone, 1)))

        return once(F.struct(words(1).alias("given"), words(-1).alias("family")), lambda known: F.transform(all_, lambda e: F.struct(
            e["found"].alias("found"), e["spelled"].alias("spelled"), split_up(e, known["given"], known["family"]).alias("parts"))))

    return once(named_, parts)


def interleaved(gaps: Column, puts: Column) -> Column:
    """Gaps with what is put behind each, as one text."""
    return F.array_join(F.zip_with(gaps, puts, lambda g, p: F.concat(g, F.coalesce(p, F.lit("")))), "")


def mentions(gap: Column, pattern: Column, names: Column) -> Column:
    """The names of a text that stand in a stretch of it without a form of address, replaced."""
    def put(word: Column) -> Column:
        known = F.get(F.filter(names, lambda n: n["word"] == F.lower(word)), F.lit(0))
        return formatted(word, F.lit("family"), known["surrogate"])

    found = F.regexp_extract_all(gap, pattern, F.lit(0))
    return interleaved(F.split(gap, pattern, -1), F.transform(found, put))


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_entities, text: a row per input row. A name counts where it is mentioned without a form of address too."""
    docs = keyed(docs)
    hit = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    rest = docs.where(~hit).select("doc_id", F.lit(0).cast("long").alias("n_entities"), "text")
    listed = docs.where(hit).withColumn("found", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    ents = listed.select("doc_id", "text_key", F.posexplode(entities_of(F.col("found"))).alias("at", "e")).select(
        "doc_id", "text_key", "at", "e.found", F.col("e.spelled").alias("whole"), F.posexplode("e.parts").alias("part", "p"))
    spots = saved(ents.select("doc_id", "text_key", "at", "part", "found", "whole", "p.kind", "p.value", "p.spelled").distinct(), "pii-spots")
    table_ = surrogate_table(spots.where("kind IS NOT NULL").select("kind", "value"), key)
    # The form of address stays before the first word of a name, the space before the second.
    front = F.when(F.col("part") == 0, F.substring("found", F.lit(1), F.length("found") - F.length("whole"))).otherwise(
        F.regexp_extract("whole", r"[ \t]+", 0))
    written = spots.join(table_, ["kind", "value"], "left").select(
        "doc_id", "text_key", "at", "part", F.col("kind").isin(*PERSON).alias("person"),
        F.struct(F.col("value").alias("word"), (F.col("kind") != "family").alias("given"), "surrogate").alias("name"),
        F.when(F.col("surrogate").isNull(), F.col("found")).otherwise(F.concat(front, formatted(F.col("spelled"), F.col("kind"), F.col("surrogate")))).alias("put"))
    whole = written.groupBy("doc_id", "text_key", "at").agg(
        F.concat(F.max(F.when(F.col("part") == 0, F.col("put"))), F.coalesce(F.max(F.when(F.col("part") == 1, F.col("put"))), F.lit(""))).alias("put"),
        F.collect_set(F.when(F.col("person"), F.col("name"))).alias("names"))
    puts = whole.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("at", "put"))).alias("puts"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    texts = docs.where(hit)
    joined = texts.join(puts, same_row(texts, puts), "left").select(texts["doc_id"], "text", "puts", "names")
    # Longer names first; a mention begins with a capital, whatever the case of the rest.
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?iu:"), F.array_join(F.sort_array("names.word", asc=False), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    joined = joined.withColumn("pattern", pattern).withColumn("gaps", F.split("text", PATTERN, -1))
    bare_ = F.when(F.size("names") > 0, F.transform("gaps", lambda g: mentions(g, F.col("pattern"), F.col("names")))).otherwise(F.col("gaps"))
    more = F.when(F.size("names") > 0, F.aggregate("gaps", F.lit(0), lambda n, g: n + F.size(F.regexp_extract_all(g, F.col("pattern"), F.lit(0))))).otherwise(0)
    rebuilt = interleaved(bare_, F.col("puts.put"))
    changed = joined.select(
        "doc_id", (F.coalesce(F.size("puts"), F.lit(0)) + F.coalesce(more, F.lit(0))).cast("long").alias("n_entities"),
        F.when(F.col("puts").isNull(), F.col("text")).otherwise(rebuilt).alias("text"))
    return rest.unionByName(changed)


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"))
