"""Plain-Python answers that the operators are held against, on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WS = " \t\n\x0b\x0c\r"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingles(text, lower: bool = False) -> set:
    text = text or ""
    w = WORD.findall(text.translate(LOWER) if lower else text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a: set, b: set) -> float:
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def kept_lines(docs: dict) -> dict:
    """doc_id -> (n_lines, n_dropped, kept text)."""

    def key(line):
        return line.strip(WS).translate(LOWER)

    where = defaultdict(set)
    for d, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                where[key(line)].add(d)
    out = {}
    for d, text in docs.items():
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(where.get(key(x), ())) < 3 or max(where[key(x)]) == d]
        out[d] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


def without_repeats(docs: dict, window: int = 200) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, kept bytes)."""
    data = {d: (t or "").encode() for d, t in docs.items()}
    found = Counter(b[i : i + window] for b in data.values() for i in range(len(b) - window + 1))
    out = {}
    for d, b in data.items():
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if found[b[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def components(docs: dict) -> dict:
    """doc_id -> (set size, smallest doc_id reachable by links)."""
    sets = {d: shingles(t, lower=True) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in docs}


def counts(text) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    held = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(held) - len(set(held)), len(covered)


def edf(parts: list[int]) -> list[int]:
    """One period of the schedule: which source has each slot."""
    total, had, out = sum(parts), [0] * len(parts), []
    for t in range(total):
        ready = [(-(-(h + 1) * total // p), i) for i, (h, p) in enumerate(zip(had, parts)) if h * total // p <= t]
        _, i = min(ready)
        had[i] += 1
        out.append(i)
    return out


def spelling(docs: list, least_n: int = 5) -> dict:
    """word -> (form, root, n, n_near, form_n); docs are (doc_id, text)."""
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least_n}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    # only words that share a deletion neighbourhood can be near
    meet = defaultdict(set)
    for w in counts:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            meet[key].add(w)
    near_of = defaultdict(set)
    for group in meet.values():
        for a in group:
            near_of[a].update(b for b in group if near(a, b))
    form = {}
    for w, n in counts.items():
        best = min(near_of[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near_of[w]), counts.get(form[w])) for w, n in counts.items()}


def hard_negatives(rows: list, k: int = 5) -> set:
    """(anchor, positive, rank, negative, positive score, negative score); rows are (vec_id, label, whole-number components)."""
    out = set()
    for i, (a, la, va) in enumerate(rows):
        if a % 100:
            continue
        others = [(sum(x * y for x, y in zip(va, v)), d, label) for d, label, v in rows if d != a]
        order = sorted(others, key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in order if r[2] == la][:k]:
            hard = [r for r in order if r[2] != la and 80 * ps <= 100 * r[0] <= 100 * ps][:k]
            out |= {(a, p, n + 1, d, ps, s) for n, (s, d, _) in enumerate(hard)}
    return out
