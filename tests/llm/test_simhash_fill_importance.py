"""SimHash index, fill-in-the-middle and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brute import words
from frames import frame  # noqa: F401
from lakestar.llm import fill_middle, importance, simhash_index
from lakestar.llm.queries import QUERIES
from lakestar.llm.words import word_runs

ODD = [(901, None), (902, ""), (903, " \n\t "), (904, "one"), (904, "one"), (None, "two words"), (None, None), (905, "One"), (906, "é ü\x0bß\x0c日本 x"),
       (907, "Ä b"), (908, "ä b"), (909, "x" * 70_000 + " y"), (910, "a,b;c d e")]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, k=3):
    w = words(low(text))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(docs, apart=2):
    codes = [simhash(t) for _, t in docs]
    name = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= apart and name[i] != name[j]:
                name = [name[j] if x == name[i] else x for x in name]
    least = {n: min((d for (d, _), x in zip(docs, name, strict=True) if x == n and d is not None), default=None) for n in name}
    return [(d, c, least[n]) for (d, _), c, n in zip(docs, codes, name, strict=True)]


def test_words_in_runs():
    pick = random.Random(5)
    for _ in range(300):
        text = "".join(pick.choice("ab \n") for _ in range(pick.randint(0, 60))).encode()
        for limit in (1, 2, 3, 7, 100):
            assert [w for run in word_runs(text, limit) for w in run] == text.split()


def variants(seed, groups, copies, length):
    pick = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{pick.randint(0, 400)}" for _ in range(length)]
        for _ in range(copies):
            w = list(base)
            for _ in range(pick.randint(0, 3)):
                w[pick.randrange(len(w))] = f"n{pick.randint(0, 10**6)}"
            docs.append((len(docs) * 3 % 1009, " ".join(w)))
    return docs


@pytest.mark.parametrize("block", [1, 8, 4096])
def test_simhash_components(frame, monkeypatch, block):
    monkeypatch.setattr(simhash_index, "BLOCK", block)
    docs = variants(1, 6, 25, 200) + [(2000 + i, f"tiny {i % 9}") for i in range(30)] + ODD
    got = simhash_index.near_fingerprints(frame(docs))
    hexed = F.lower(F.lpad(F.hex("code"), 16, "0"))
    expected = [(d, f"{c:016x}", n) for d, c, n in near_groups(docs)]
    assert collected(got.withColumn("code", hexed), "doc_id", "code", "component_id") == sorted(expected, key=repr)
    assert len({n for _, _, n in expected}) < len({c for _, c, _ in expected})


def test_simhash_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = collected(QUERIES["op11_simhash_near_dedup"](spark, sf), "doc_id", "fingerprint", "component_id")
    assert got == sorted(((d, f"{c:016x}", n) for d, c, n in near_groups(docs)), key=repr)


def test_simhash_of_nothing(frame):
    assert simhash_index.near_fingerprints(frame([])).count() == 0
    assert collected(simhash_index.near_fingerprints(frame([(3, None), (2, " "), (None, "")])), "code", "component_id") == [(0, 2)] * 3


def test_runs_of_words_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(f"v{i % 313}" for i in range(5000))
    whole = simhash_index.fingerprint(text.encode(), 3)
    monkeypatch.setattr("lakestar.llm.simhash_index.word_runs", lambda t: word_runs(t, 100))
    assert simhash_index.fingerprint(text.encode(), 3) == whole == simhash(text) - (2**64 if simhash(text) >= 2**63 else 0)


def test_near_pairs_against_all_pairs():
    """Random codes, a dense ball of codes around one, and a walk whose neighbours are two bits apart."""
    pick = np.random.default_rng(3)
    centre = pick.integers(0, 2**63, dtype=np.uint64)
    ball = [centre ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in pick.integers(0, 64, (900, 2))]
    chain = [centre := centre ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in pick.integers(0, 64, (200, 2))]
    codes = np.unique(np.concatenate([pick.integers(0, 2**64, 1500, dtype=np.uint64), ball, chain]))
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    differ = np.bitwise_count(codes[:, None] ^ codes[None, :])
    expected = {(i, j) for i, j in np.argwhere(differ <= 2).tolist() if i < j}
    tree = simhash_index.levels(codes)
    found = [pair for i, j in simhash_index.near_pairs(tree, tree, True, 2) for pair in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 2000
    x, y = codes[:700], codes[700:]
    found = {(a, b + 700) for i, j in simhash_index.near_pairs(simhash_index.levels(x), simhash_index.levels(y), False, 2)
             for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert found == {(i, j) for i, j in expected if i < 700 <= j}


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def filled(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha, sha), text
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h[3] % 100 < 80 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return (doc_id, n, form, len(pre), len(mid), hashlib.sha256(out.encode()).hexdigest(), sha), out


@pytest.mark.parametrize("piece", [1, 50, 1 << 16])
def test_fill_in_the_middle(frame, monkeypatch, piece):
    monkeypatch.setattr(fill_middle, "PIECE", piece)
    pick = random.Random(6)
    docs = [(i, "".join(pick.choice(["a", "é<", "日", " ", "\n", "<S", "P>", "<", ">"]) for _ in range(pick.randint(0, 40)))) for i in range(200)]
    docs += [(300 + i, f"some {mark} text") for i, mark in enumerate(("<P>", "<S>", "<M>", "<X>") * 8)] + ODD
    docs += [(400, " lead and trail \n"), (400, " lead and trail \n"), (401, "w " * 40_000)] + [(402, "again and again")] * 50
    out = fill_middle.assembled(frame(docs))
    expected = [filled(*d) for d in docs]
    got = collected(fill_middle.digests(out), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    assert got == sorted((e[0] for e in expected), key=repr)
    assert collected(fill_middle.texts(out), "doc_id", "form", "output") == sorted(((e[0], e[2], text) for e, text in expected), key=repr)
    assert {e[0][2] for e in expected} == {"plain", "psm", "spm"}


def test_restoration_reads_the_output():
    """The digest of the restored text follows from the streamed bytes alone, wherever the pieces meet."""
    for form, out, text in (("psm", b"<P>a <<S>c<M>b<", b"a <b<c"), ("spm", b"<S><P><P>x<M>y", None), ("spm", b"<S>s <P><M>m ", b"m s ")):
        for size in range(1, len(out) + 1):
            state = fill_middle.Output(form)
            runs = [r for at in range(0, len(out), size) for r in state.add(out[at:at + size])] + state.add(b"", last=True)
            if text:
                assert b"".join(r for _, _, r in sorted(runs)) == text
                assert state.digest.hexdigest() == hashlib.sha256(out).hexdigest()


def test_fill_in_the_middle_of_nothing(frame):
    assert fill_middle.digests(fill_middle.assembled(frame([]))).count() == 0
    assert fill_middle.texts(fill_middle.assembled(frame([]))).count() == 0


FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n=2):
    w = FEATURE.findall(low(text))
    return len(w), [" ".join(w[i:i + m]) for m in range(1, n + 1) for i in range(len(w) - m + 1)]


def drawn(docs, target, buckets=10_000):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in grams(t)[1])

    s, t = counts(x for _, x in docs), counts(target)
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    rows = []
    for doc_id, text in docs:
        n, f = grams(text)
        weight = sum(gain(zlib.crc32(x.encode()) % buckets) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:25 * len(able) // 100]):
        r[5] = rank + 1
    return [tuple(r) for r in rows]


def test_importance(spark, frame):
    pick = random.Random(7)
    vocabulary = [f"word{i}" for i in range(50)] + ["Ärger", "x", "don't", "a-b", "日本"]
    docs = [(i, " ".join(pick.choice(vocabulary[i % 9:]) for _ in range(pick.randint(1, 80)))) for i in range(300)] + ODD
    docs += [(i, "same text here " * 9) for i in range(1000, 1020)] + [(1030, "copy of a row " * 6)] * 12 + [(None, "no id " * 15)] * 5
    target = [" ".join(pick.choice(vocabulary[30:]) for _ in range(40)) for _ in range(20)] + [None, ""]
    got = importance.resampled(frame(docs), spark.createDataFrame([(t,) for t in target], "text string"))
    assert collected(got, "doc_id", "n_words", "n_features", "weight", "score", "rank") == sorted(drawn(docs, target), key=repr)


def test_importance_of_nothing(spark, frame):
    nothing = spark.createDataFrame([], "text string")
    assert importance.resampled(frame([]), nothing).count() == 0
    assert collected(importance.resampled(frame(ODD), nothing), "rank") == [(None,)] * len(ODD)


def test_crc_of_any_part_from_two_prefixes():
    shift, pick = importance.Shift(), np.random.default_rng(1)
    for length in (0, 1, 2, 63, 64, 65, 127, 4096, 100_003):
        data = pick.integers(0, 256, 200 + length, dtype=np.uint8).tobytes()
        for a in (0, 1, 57):
            before, after = np.array([zlib.crc32(data[:a])], np.uint32), zlib.crc32(data[:a + length])
            assert int(after ^ shift(before, np.array([length]))[0]) == zlib.crc32(data[a:a + length])
        assert int(shift.blank(np.array([zlib.crc32(data)], np.uint32))[0]) == zlib.crc32(data + b" ")


@pytest.mark.parametrize("run", [1, 30, 1 << 20])
def test_features_across_runs(monkeypatch, run):
    """Features of three words, in runs that part texts anywhere."""
    import pyarrow as pa

    monkeypatch.setattr(importance, "RUN_BYTES", run)
    texts = ["a b c d e", None, "", "One, TWO three", "x", "y z", "long" * 50 + " tail of it"]
    found = Counter()
    for bucket, row, _ in importance.features(pa.array(texts), 3, 10_000, importance.Shift()):
        found.update(zip(row.tolist(), bucket.tolist(), strict=True))
    assert found == Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in grams(t, 3)[1])
