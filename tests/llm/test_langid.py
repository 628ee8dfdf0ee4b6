import zlib

import numpy as np
from llm.brute import awkward, no_rows

from conftest import SF_DIR
from reviewlake.llm.common import table
from reviewlake.llm.langid import (
    WEIGHT, Letters, drop_undetermined, gram_vectors, identify, learn, trigrams,
)


def plain_grams(text):
    symbols = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in symbols:
        symbols = symbols.replace("  ", " ")
    return [symbols[i:i + 3] for i in range(len(symbols) - 2)]


def test_trigrams_by_hand(monkeypatch):
    text = "Ab, ab9 Éa!" * 3
    for size in (1 << 20, 5, 7):
        monkeypatch.setattr("reviewlake.llm.langid.SLICE", size)
        codes, counts = trigrams(text)
        got = {"".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)): n for c, n in zip(codes.tolist(), counts.tolist())}
        want = {}
        for g in plain_grams(text):
            want[g] = want.get(g, 0) + 1
        assert got == want


def test_binding_by_hand():
    letters = Letters(64)
    a, b, c = letters(np.array([ord(x) for x in "abc"]))
    gram = np.array([(ord("a") << 42) | (ord("b") << 21) | ord("c")])
    assert (gram_vectors(gram, letters)[0] == np.roll(a, 2) * np.roll(b, 1) * c).all()


def dense(text, letters):
    return sum(np.roll(letters(np.array([ord(g[0])]))[0], 2).astype(int) * np.roll(letters(np.array([ord(g[1])]))[0], 1)
               * letters(np.array([ord(g[2])]))[0] for g in plain_grams(text))


def test_against_brute_force(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([
        ("the cat and the dog", "en"), ("le chat et la souris", "fr"), ("the house on the hill", "en"),
        ("der Hund und die Katze", "de"), ("la maison de la forêt", "fr"), ("das Haus auf dem Berg", "de"),
        ("the end", None), ("la fin", None), ("1234", "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    letters, sums = Letters(), {}
    for i, text, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 4 != 2 and any(c.isalpha() for c in text):
            grams = plain_grams(text)
            share = {g: grams.count(g) * WEIGHT // len(grams) for g in set(grams)}
            for g, weight in share.items():
                one = np.roll(letters(np.array([ord(g[0])]))[0], 2).astype(int) * np.roll(
                    letters(np.array([ord(g[1])]))[0], 1) * letters(np.array([ord(g[2])]))[0]
                sums[lang] = sums.get(lang, 0) + weight * one
    for r in identify(docs).collect():
        text = rows[r["doc_id"]][1]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        v = dense(text, letters)
        cosines = {l: float(v @ s / np.linalg.norm(v) / np.linalg.norm(s)) for l, s in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r["lang_pred"] == best and abs(r["score"] - max(0, cosines[best])) < 1e-6


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = identify(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    lettered = sum(any(c.isalpha() for c in r["text"] or "") for r in docs.collect())
    assert sum(r["lang_pred"] != "und" for r in got) == lettered == drop_undetermined(docs).count()
    assert drop_undetermined(docs).columns == docs.columns


def test_nothing_to_learn(spark):
    docs = awkward(spark)
    assert identify(no_rows(docs)).count() == 0
    nothing = docs.withColumn("lang", docs["lang"].substr(9, 0)).where("lang is null or lang != ''")
    assert learn(nothing) == {} and {r["lang_pred"] for r in identify(nothing).collect()} <= {"und"}


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    joined = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    total, right = joined.count(), joined.where("lang = lang_pred").count()
    assert total >= 20 and right >= 0.95 * total
