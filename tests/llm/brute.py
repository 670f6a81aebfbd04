"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def removed_words(docs, window):
    """Per row: words, removed words, kept text. Rows that repeat are one document."""
    places = defaultdict(set)
    for key in set(docs):
        w = words(key[1])
        for i in range(len(w) - window + 1):
            places[tuple(w[i:i + window])].add((key, i))
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if len(places[tuple(w[i:i + window])]) > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k=3):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if len(w) >= k else frozenset([tuple(w)])


def jaccard_rows(docs, k=3, share=(90, 100)):
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and share[1] * len(sets[i] & sets[j]) >= share[0] * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        names[find(i)].append(doc_id)
    name = {r: min((x for x in ids if x is not None), default=None) for r, ids in names.items()}
    return [(d, len(s), name[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def top_k(vectors, k, every):
    clean = {(i, tuple(float(math.floor(256 * x)) for x in v)) for i, v in vectors
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in clean:
        if q % every == 0:
            scored = sorted({(-int(sum(a * b for a, b in zip(x, y, strict=False))), c) for c, y in clean if c != q})[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    return out


def base_figures(text):
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    cover = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover), failed)


def kept_by_rules(text):
    n, chars, symbols, dup, _, failed = base_figures(text)
    if failed:
        return False
    w = words(text)
    letters = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", x)) for x in w)
    capitals = sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in w)
    lines = len([x for x in text.split("\n") if words(x)])
    return not (10 * symbols > n or chars < 3 * n or chars > 12 * n or 100 * dup > 30 * lines or 100 * letters < 80 * n
                or 2 * capitals > n or 100 * max(Counter(w).values()) > 30 * n)


def template_of_lines(forms, min_docs, constant):
    """The template of each line form; ``forms`` maps a tuple of tokens to the number of its texts."""
    def mask(form):
        return ["<*>" if re.search("[0-9]", t) else t for t in form]

    weight, members, ways = Counter(), defaultdict(set), {}
    for form, texts in forms.items():
        if len(form) > 3:
            lead = mask(form)[:6]
            own = [(len(form), *("<*>" if i == j else t for i, t in enumerate(lead))) for j in (None, *range(6))]
            ways[form] = list(dict.fromkeys(own))
            for path in ways[form]:
                weight[path] += texts
                members[path].add(form)
    leaf = {}
    for form, own in ways.items():
        busy = [p for p in own if weight[p] >= min_docs and len(members[p]) > 1]
        if busy:
            leaf[form] = own[0] if busy[0] == own[0] else max(busy, key=lambda p: weight[p])
    often = Counter()
    for form, path in leaf.items():
        for i, t in enumerate(mask(form)):
            often[path, i, t] += forms[form]
    out = {}
    for form in forms:
        fields = [t if t != "<*>" and form in leaf and often[leaf[form], i, t] >= min_docs else None for i, t in enumerate(mask(form))]
        enough = form in leaf and sum(f is not None for f in fields) >= constant * len(form)
        out[form] = ("tree", leaf[form], tuple(fields)) if enough else ("own", form)
    return out


def dropped_lines(docs, min_docs=10, repeated=100, constant=0.7, copied=0.75, edge=8):
    """Per row: lines, dropped lines, kept text."""
    texts = {t: [(i, tuple(words(x))) for i, x in enumerate(t.split("\n")) if words(x)] for t in {t for _, t in docs if t is not None}}
    forms = Counter(f for rows in texts.values() for f in {f for _, f in rows})
    template = template_of_lines(forms, min_docs, constant)

    def needed(n):
        return max(2, min(min_docs, math.ceil(repeated / n)))

    stands, size = defaultdict(set), {}
    for t, rows in texts.items():
        for _, f in rows:
            stands[template[f]].add(t)
            size[template[f]] = len(f)
    held = {k: v for k, v in stands.items() if len(v) >= needed(size[k])}
    near = set().union(*held.values())
    shown = {f: tuple("<*>" if re.search("[0-9]", x) else x for x in f) for f in forms}
    ends = Counter(e for t in near for e in {e for _, f in texts[t] for e in (("head", shown[f][:edge]), ("tail", shown[f][-edge:]))})
    votes = Counter()
    for key, where in held.items():
        for t in where:
            beside = 0
            for _, f in texts[t]:
                common = max(ends["head", shown[f][:edge]], ends["tail", shown[f][-edge:]])
                if common > 1 and common.bit_length() >= len(where).bit_length() - 1:
                    beside += len(f)
            votes[key] += beside < copied * sum(len(f) for _, f in texts[t])
    gone = {t: {i for i, f in rows if votes[template[f]] >= needed(len(f))} for t, rows in texts.items()}
    out = []
    for doc_id, text in docs:
        lines = text.split("\n") if text is not None else []
        kept = [x for i, x in enumerate(lines) if i not in gone[text]]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept) if text is not None else None))
    return out


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - most * sum(sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share[s] for s in names}
        full |= over
