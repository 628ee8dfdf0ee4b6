from collections import Counter, defaultdict

from llm.brute import awkward, no_rows

from reviewlake.llm.lines import remove_boilerplate


def brute(rows, min_sites, min_chars):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n") if text is not None else ():
            if len(line.strip(" ")) >= min_chars:
                sites[line.strip(" ")].add(site or "")
    out = Counter()
    for d, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if len(sites[x.strip(" ")]) < min_sites]
        out[(d, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept))] += 1
    return out


def test_near_the_limit(spark):
    rows = [(i, f"own line number {i}\n a line on {n} sites \nshort\na line on {n} sites", f"site{i % n}")
            for n in (2, 3, 4, 5, 30) for i in range(n * 3)]
    rows += [(i, "many sites have this line", f"wide{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(tuple(r) for r in remove_boilerplate(docs, min_sites=4, min_chars=10).collect())
    assert got == brute(rows, 4, 10)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    got = Counter(tuple(r) for r in remove_boilerplate(docs, min_sites=2, min_chars=3).collect())
    assert got == brute(rows, 2, 3)
    assert remove_boilerplate(no_rows(docs)).count() == 0
