import zlib
from collections import Counter

import pytest
from llm.brute import awkward, no_rows, sha

from reviewlake.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return sha("".join(field(row[c]) for c in FIELDS).encode())


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and for every node its siblings per level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, i in enumerate(at):
            first = i // 16 * 16
            run = nodes[first:first + 16]
            paths[n].append(("".join(run[:i - first]), "".join(run[i - first + 1:])))
        nodes = [sha("".join(nodes[i:i + 16]).encode()) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    found = []
    for s in order:
        held = sorted(sources[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        found.append((held, *tree([leaf(r) for r in held])))
    root, tops = tree([f[1] for f in found])
    out = Counter()
    for (held, subroot, paths), top in zip(found, tops):
        for r, path in zip(held, paths):
            whole = path + top
            d = r["doc_id"]
            hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
            h = leaf(r | {"text": lowered(r["text"])}) if hit else leaf(r)
            for a, b in whole:
                h = sha((a + h + b).encode())
            out[(d, leaf(r), subroot, root, sha("".join(a + b for a, b in whole).encode()), h, h == root)] += 1
    return out


def check(docs):
    rows = [r.asDict() for r in docs.collect()]
    assert Counter(tuple(r) for r in merkle.manifest(docs).collect()) == brute(rows)


def test_awkward_rows(spark):
    check(awkward(spark, [(i, "Capital Text") for i in range(20, 50)]))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16], [17, 1], [257, 3], [1] * 18, [300, 16, 1, 2] + [1] * 20])
def test_shapes(spark, sizes):
    rows = [(n * 1000 + i, f"s{n:03d}" if n else None, "en", i, f"Row {i} of {n}", 0) for n, k in enumerate(sizes) for i in range(k)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string, lo long"))


def test_empty_table(spark):
    assert merkle.manifest(no_rows(awkward(spark))).count() == 0


def test_sources_in_byte_order(spark):
    rows = [(i, s, None, None, "x" * 70000) for i, s in enumerate(["é", "z", "Z", "", None, "\U0001F600", "￿", "a,b"] * 3)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string"))
