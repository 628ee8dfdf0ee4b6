"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, body string, uid int, fp string"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def awkward(spark, texts=None):
    """Documents with nulls in every column, empty, blank and repeated rows, ties, and clashing names."""
    common = "the same text on many rows, word for word"
    rows = [(1, common), (2, common), (3, common), (3, common), (None, common), (4, None), (5, ""), (6, ""),
            (7, "  \t\n "), (8, "12 34 !!"), (9, "Été déjà vu à l'hôtel du lac de la forêt"), (None, None),
            (10, "x" * 5000), (11, "one"), (11, "one two"), (12, "a b"), (13, "don't  stop \n\n now' s 'twas 10,000"),
            (14, "日本語の文章 と English<|endoftext|> mixed   spaces\x1c end")]
    rows += texts or []
    return spark.createDataFrame(
        [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", n, "id", None, n, "fp")
         for n, (i, t) in enumerate(rows)], DOC_SCHEMA)


def no_rows(df):
    return df.limit(0)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words(text: str | None, breaks: str) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(breaks, low) if w]


def contamination(docs, items, window=10):
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for (doc_id, text) and (item_id, text)."""
    breaks = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wanted = defaultdict(set)
    for item_id, text in items:
        w = words(text, breaks)
        size = min(window, len(w))
        for s in range(len(w) - size + 1) if w else ():
            wanted[tuple(w[s:s + size])].add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text, breaks), set(), set()
        for size in {len(k) for k in wanted}:
            for s in range(len(w) - size + 1):
                if ids := wanted.get(tuple(w[s:s + size])):
                    hit |= set(range(s, s + size))
                    found |= ids
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def near_items(docs, items, window=10, distance=20):
    """Per document the number of items of which a passage's words stand close together."""
    breaks = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    texts = [words(t, breaks) for _, t in docs]
    tf = Counter(w for t in texts for w in t)
    passages = set()
    for item_id, text in items:
        w = words(text, breaks)
        size = min(window, len(w))
        if size:
            for s in {*range(0, len(w) - size + 1, size), len(w) - size}:
                passages.add(("" if item_id is None else str(item_id), frozenset(w[s:s + size])))
    found = []
    for w in texts:
        ids = set()
        for item_id, terms in passages:
            required, known = max(2, -(-4 * len(terms) // 5)), sorted((tf[t], t.encode()) for t in terms if tf[t])
            if len(known) >= required:
                first, second = (t.decode() for _, t in known[:2])
                for pos in (i for i, t in enumerate(w) if t == first):
                    around = set(w[max(0, pos - distance):pos + distance + 1])
                    if second in around and len(around & terms) >= required:
                        ids.add(item_id)
        found.append(len(ids))
    return found


def fingerprint(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    size = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + size]).encode(), 42) for i in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, radius=2):
    """(doc_id, fingerprint, component_id): every pair of distinct fingerprints is compared."""
    prints = [(d, fingerprint(t)) for d, t in docs]
    root = {f: f for _, f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = list(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in prints]


def kept_exact(docs):
    best = {}
    for d, t in docs:
        key = t or ""
        best[key] = max(best.get(key, (-1, None)), (-1 if d is None else d, t), key=lambda x: x[0])
    return list(best.values())
