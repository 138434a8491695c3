"""Plain restatements of the contracts, one document after the other, to test against."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = {i: i + 32 for i in range(65, 91)}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def lower(x):
    return (x or "").translate(A_TO_Z)


def fold(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


def decontaminate(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if items_ := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= items_
        out[doc_id] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def base_scores(docs):
    counts = Counter()
    for doc_id, text in docs:
        if fold(doc_id, 10):
            counts.update(TOKEN.findall(lower(text)))
            counts[None] += 1
    total = sum(counts.values())
    out = {}
    for doc_id, text in docs:
        tokens = [*TOKEN.findall(lower(text)), None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in tokens)
        out[doc_id] = (fold(doc_id, 10) == 0, len(tokens), sum(counts[t] > 0 for t in tokens), total, base)
    return out


def level_mean(count):
    """Mean count of the level that a count reaches."""
    if not count:
        return 0
    level = max(i for i in range(60) if math.ceil(1.5**i) <= count)
    return (math.ceil(1.5**level) + math.ceil(1.5 ** (level + 1)) - 1) / 2


def pair_scores(docs, learned, smoothing=100):
    """Scores by the levels of exact counts; None is the end mark."""
    words, pairs = Counter(), Counter()
    for _, text in learned:
        tokens = [None, *TOKEN.findall(lower(text)), None]
        words.update(tokens[1:])
        pairs.update(zip(tokens, tokens[1:]))
    denominator = sum(words.values()) + 0.1 * (len(words) + 1)
    out = {}
    for doc_id, text in docs:
        tokens = [None, *TOKEN.findall(lower(text)), None]
        out[doc_id] = 0
        for v, w in zip(tokens, tokens[1:]):
            before, own = level_mean(words[v]), (level_mean(words[w]) + 0.1) / denominator
            both = min(level_mean(pairs[v, w]), before)
            out[doc_id] += math.log10((both + smoothing * own) / (before + smoothing))
    return out


def removed(units, first, doc_id, length):
    """Which units a window that also starts in a smaller document covers."""
    gone = [False] * len(units)
    for i in range(len(units) - length + 1):
        if first[units[i : i + length]] < doc_id:
            gone[i : i + length] = [True] * length
    return gone


def _first(docs, length):
    first = {}
    for doc_id, units in docs:
        for i in range(len(units) - length + 1):
            window = units[i : i + length]
            first[window] = min(first.get(window, doc_id), doc_id)
    return first


def substrings(docs, length=50):
    docs = [(i, tuple(TOKEN.findall(t or ""))) for i, t in docs]
    first = _first(docs, length)
    out = {}
    for doc_id, words in docs:
        gone = removed(words, first, doc_id, length)
        out[doc_id] = (len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g)))
    return out


def suffixes(docs, length=50):
    docs = [(i, (t or "").encode()) for i, t in docs]
    first = _first(docs, length)
    out = {}
    for doc_id, raw in docs:
        gone = removed(raw, first, doc_id, length)
        spans = sum(g and not b for g, b in zip(gone, [False, *gone]))
        out[doc_id] = (len(raw), sum(gone), spans, sha(bytes(x for x, g in zip(raw, gone) if not g)))
    return out


def shingles(text, width=5):
    words = TOKEN.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for i, s in sets.items():
        for x in s:
            having.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = Counter(j for x in s for j in having[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def top(vectors, every=50, best=5):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, v in whole.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole.items() if i != q)
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:best], 1)}
    return out


def interactions(docs, labels):
    """(part, order, step) to the counts; ``docs`` are (doc_id, text, part), ``labels`` (doc_id, quality, toxic)."""
    marks = {}
    for doc_id, quality, toxic in labels:
        good, bad = marks.get(doc_id, (False, False))
        marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    rows = []
    for doc_id, text, part in docs:
        text = text or ""
        words = TOKEN.findall(text)
        earlier = doc_id is not None and any((t or "") == text and i is not None and i < doc_id for i, t, _ in docs)
        tests = (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text), earlier,
        )
        fails = {x for x, failed in zip("ABCDE", tests, strict=True) if failed}
        rows.append((part or "", fails, *(marks.get(doc_id, (False, False)) if doc_id is not None else (False, False))))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        removed_by = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                removed_by[x] += len(gone)
                failing = sum(x in r[0] for r in own)
                alone = sum(r[0] == {x} for r in own)
                out[part, "".join(order), step] = (len(left), len(gone), failing - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone))
        for (p, order, step), found in list(out.items()):
            if p == part:
                out[p, order, step] = (*found, removed_by[order[step - 1]])
    return out


def shards(docs, shards):
    """doc_id and text in order to (shard, slot), by trying capacities one after the other."""
    groups = {}
    for doc_id, text in sorted(docs):
        groups.setdefault(text or "", []).append(doc_id)
    groups = list(groups.items())
    sizes = [len(ids) * (len(text.encode()) + 1) for text, ids in groups]

    def cut(capacity):
        out, used, shard = [], 0, 0
        for size in sizes:
            if size > capacity:
                return None
            if used + size > capacity:
                shard, used = shard + 1, 0
            used += size
            out.append(shard)
        return out if not out or out[-1] < shards else None

    low, high = 0, max(1, sum(sizes))
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if cut(middle) else (middle, high)
    slots, out = Counter(), {}
    for (text, ids), shard in zip(groups, cut(high) or [], strict=True):
        for doc_id in ids:
            out[doc_id] = (shard, slots[shard], len(text.encode()) + 1, zlib.crc32(text.encode()))
            slots[shard] += 1
    return out


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """vec_id and vector to (code, error), and the digest of the codebooks, with plain integers."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    first = {}
    for i, v in sorted(kept):
        first.setdefault(i, v)
    books = [[v[p * width : (p + 1) * width] for v in list(first.values())[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            chosen = [nearest(v[p], books[p])[1] for v in cut]
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(cut, chosen, strict=True) if c == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = []
    for (i, _), v in zip(kept, cut, strict=True):
        near = [nearest(v[p], books[p]) for p in range(parts)]
        found.append((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near)))
    return found, sha(",".join(str(x) for book in books for entry in book for x in entry))
