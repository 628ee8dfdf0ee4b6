"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (document, position) for every occurrence of a
benchmark word in the training documents; other words can never be part of a
match. A window of a benchmark item is looked up from its two rarest words:
their postings, shifted by the words' offsets in the item, must meet in the
same alignment of item and document. Surviving alignments are verified against
the postings of all the item's words, and runs of matching words that are long
enough are the exact occurrences.

Proximity finds passages that were reworded. An item is cut into passages of
one window's length (the last one ends with the item). Of a passage's distinct
words, the two that are rarest among those the documents have must stand within
a distance of each other, and around the rarest one four fifths of the
passage's distinct words within that distance; order and repeats don't count.

Everything is DataFrame operations. Postings of one very common word are
spread by document; nothing is collected per word, and an alignment has at
most an item's words.

Defined results: a null or wordless document has no words and no hits; items
without words have no windows; a null item_id counts as the empty id; items
that repeat an id count once; document ids may be null or repeat, each row
keeps its own result; empty tables on either side give no hits; other columns
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, stored

WINDOW = 10
#: Words on either side of a passage's rarest word in which proximity looks for the others.
DISTANCE = 20
#: Characters that separate words once A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows and bytes up to which a small side is sent to every executor; beyond, it is shuffled.
SEND_ROWS, SEND_BYTES = 500_000, 64 << 20
#: Types whose values take at most 16 bytes.
FIXED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp"}


def words(text: Column) -> Column:
    """The words of a text; only A-Z are lower-cased."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BREAK), "")


def sent(small: DataFrame, most: int = SEND_BYTES) -> DataFrame:
    """A stored table, marked for broadcast only if its rows and bytes are counted to be few."""
    wide = [name for name, kind in small.dtypes if kind not in FIXED]
    size = sum((F.coalesce(F.octet_length(named(name).cast("string")), F.lit(0)) for name in wide),
               F.lit(16 * len(small.columns)))
    rows, size = small.limit(SEND_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(small) if rows <= SEND_ROWS and size <= most else small


def item_words(items: DataFrame, item_id: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Stored rows (item, item_id, p, word, n, need) of the benchmark's words."""
    distinct = items.select(F.coalesce(named(item_id).cast("string"), F.lit("")).alias("item_id"),
                            words(body(text_col)).alias("words")).where(F.size("words") > 0).distinct()
    numbered = stored(distinct.withColumn("item", F.monotonically_increasing_id()), "items")
    return stored(numbered.select(
        "item", "item_id", F.size("words").alias("n"), F.least(F.lit(window), F.size("words")).alias("need"),
        F.posexplode("words").alias("p", "word")), "item-words")


def build_index(docs: DataFrame, item_terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (uid, pos, word) of the items' words.

    Each document has one more row, with the empty word, its id, a hash of its
    text and, as position, its number of words.
    """
    terms = stored(item_terms.select("word").union(
        item_terms.sparkSession.createDataFrame([("",)], "word string")).distinct(), "terms")
    text = body(text_col)
    # Numbered before exploding: a generator's projection would number the exploded rows.
    numbered = docs.select(
        F.monotonically_increasing_id().alias("uid"), named(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
        F.concat(words(text), F.array(F.lit(""))).alias("words"))
    exploded = numbered.select("uid", "id", "text_hash", F.posexplode("words").alias("pos", "word"))
    end = F.col("word") == ""
    return stored(exploded.join(sent(terms), "word").select(
        "uid", "pos", "word", F.when(end, F.col("id")).alias("id"),
        F.when(end, F.col("text_hash")).alias("text_hash")), "postings")


def rarest(index: DataFrame, item_terms: DataFrame) -> DataFrame:
    """Per window that can occur at all: (item, s, p1, w1, p2, w2), its two rarest words.

    A window of one word has it twice.
    """
    counts = index.where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("tf"))
    seen = item_terms.join(counts, "word", "left")
    starts = F.sequence(F.greatest(F.lit(0), F.col("p") - F.col("need") + 1),
                        F.least(F.col("p"), F.col("n") - F.col("need")))
    spread = seen.select("item", "p", "word", "tf", F.explode(starts).alias("s"))
    of = Window.partitionBy("item", "s")
    ranked = (spread.withColumn("least", F.min(F.coalesce("tf", F.lit(0))).over(of)).where("least > 0")
              .withColumn("rank", F.row_number().over(of.orderBy("tf", "p"))).where("rank <= 2"))
    pick = lambda name, rank: F.max(F.when(F.col("rank") == rank, F.col(name)))
    two = ranked.groupBy("item", "s").agg(
        pick("p", 1).alias("p1"), pick("word", 1).alias("w1"), pick("p", 2).alias("p2"), pick("word", 2).alias("w2"))
    return stored(two.select("item", "s", "p1", "w1", F.coalesce("p2", "p1").alias("p2"),
                             F.coalesce("w2", "w1").alias("w2")), "rarest")


def alignments(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct (uid, item, shift) in which both rarest words of some window meet.

    The shift is negative where a document begins inside the item.
    """
    anchors = stored(windows.select("item", F.col("p1").alias("p"), F.col("w1").alias("word"))
                     .union(windows.select("item", "p2", "w2")).distinct(), "anchors")
    shifted = index.select("uid", "pos", "word").join(sent(anchors), "word").select(
        "uid", "item", (F.col("pos") - F.col("p")).alias("shift"), "p")
    shifted = stored(shifted, "shifted")
    first = shifted.join(sent(stored(windows.select("item", F.col("p1").alias("p"), "p2").distinct(), "pairs")),
                         ["item", "p"])
    second = shifted.select("uid", "item", "shift", F.col("p").alias("p2"))
    return first.join(second, ["uid", "item", "shift", "p2"], "left_semi").select("uid", "item", "shift").distinct()


def phrase_matches(index: DataFrame, item_terms: DataFrame) -> DataFrame:
    """Exact runs (uid, item, from_pos, to_pos): every word from first to last is in some occurring window."""
    found = stored(alignments(index, rarest(index, item_terms)), "alignments")
    expected = found.join(item_terms.select("item", "p", "word", "need"), "item").select(
        "uid", "item", "shift", "p", "need", "word", (F.col("shift") + F.col("p")).alias("pos"))
    near_docs = stored(found.select("uid").distinct(), "aligned-docs")
    postings = index.select("uid", "pos", "word")
    if near_docs.limit(SEND_ROWS + 1).count() <= SEND_ROWS:
        postings = postings.join(F.broadcast(near_docs), "uid", "left_semi")
    met = expected.join(postings, ["uid", "pos", "word"], "left_semi")
    line = Window.partitionBy("uid", "item", "shift").orderBy("p")
    return (met.withColumn("run", F.col("p") - F.row_number().over(line))
            .groupBy("uid", "item", "shift", "run", "need")
            .agg(F.min("pos").alias("from_pos"), F.max("pos").alias("to_pos"))
            .where("to_pos - from_pos + 1 >= need").select("uid", "item", "from_pos", "to_pos"))


def near_passages(index: DataFrame, item_terms: DataFrame) -> DataFrame:
    """Stored (item, s, w1, w2, required, words) of passages that have enough words in the documents.

    ``w1`` and ``w2`` are the rarest of them, ties by the word. Passages of one distinct word have no pair and are left
    to the exact search.
    """
    counts = index.where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("tf"))
    aligned, last = F.col("p") - F.col("p") % F.col("need"), F.col("n") - F.col("need")
    starts = F.array_distinct(F.array(F.when(aligned <= last, aligned), F.when(F.col("p") >= last, last)))
    spread = (item_terms.select("item", "word", F.explode(starts).alias("s")).where("s is not null").distinct()
              .join(counts, "word", "left"))
    # At most a window's words are collected.
    passages = spread.groupBy("item", "s").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("tf").isNotNull(), F.struct("tf", "word")))).alias("known"))
    required = F.greatest(F.lit(2), F.ceil(F.col("n") * 4 / 5))
    return stored(passages.where(F.size("known") >= required).select(
        "item", "s", F.col("known")[0]["word"].alias("w1"), F.col("known")[1]["word"].alias("w2"),
        required.cast("int").alias("required"), F.col("known.word").alias("words")), "passages")


def near_matches(index: DataFrame, item_terms: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Proximity: distinct (uid, item, s, pos), an item's passage and the place of its rarest word in a document.

    Postings meet by document and stretch of positions; both joins only ask whether a posting is there, so no pair of
    places is listed.
    """
    passages = near_passages(index, item_terms)
    stretch = lambda pos: F.floor(pos / (2 * distance + 1))
    touched = F.explode(F.array_distinct(F.array(stretch(F.col("pos") - distance), stretch(F.col("pos") + distance))))
    postings = index.where("word != ''").select(
        "uid", "word", F.col("pos").alias("there"), stretch(F.col("pos")).alias("stretch"))

    def met(asked: DataFrame, among: DataFrame) -> DataFrame:
        where = (asked["uid"] == among["uid"]) & (asked["word"] == among["word"]) & (
            asked["stretch"] == among["stretch"]) & (F.abs(asked["pos"] - among["there"]) <= distance)
        return asked.join(among, where, "left_semi")

    first = index.select("uid", "pos", F.col("word").alias("w1")).join(
        sent(passages.select("item", "s", "w1", F.col("w2").alias("word"))), "w1")
    seconds = sent(stored(passages.select(F.col("w2").alias("word")).distinct(), "second-words"))
    found = stored(met(first.select("uid", "item", "s", "pos", "word", touched.alias("stretch")),
                       postings.join(seconds, "word", "left_semi"))
                   .select("uid", "item", "s", "pos").distinct(), "near-pairs")
    documents = stored(found.select("uid").distinct(), "near-docs")
    asked = found.join(sent(passages.select("item", "s", "required", "words")), ["item", "s"]).select(
        "uid", "item", "s", "pos", "required", F.explode("words").alias("word"))
    asked = asked.select("uid", "item", "s", "pos", "required", "word", touched.alias("stretch"))
    return (met(asked, postings.join(sent(documents), "uid", "left_semi"))
            .groupBy("uid", "item", "s", "pos", "required").agg(F.count_distinct("word").alias("words"))
            .where("words >= required").select("uid", "item", "s", "pos"))


def covered(matches: DataFrame) -> DataFrame:
    """(uid, n_hit): words inside the union of a document's runs."""
    spans = matches.select("uid", "from_pos", "to_pos").distinct()
    before = (Window.partitionBy("uid").orderBy("from_pos", "to_pos")
              .rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest("from_pos", F.coalesce(F.max("to_pos").over(before) + 1, F.col("from_pos")))
    return (spans.select("uid", (F.col("to_pos") - fresh + 1).alias("new")).where("new > 0")
            .groupBy("uid").agg(F.sum("new").cast("long").alias("n_hit")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  distance: int | None = None) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash.

    With a ``distance`` also n_near, the number of items with a proximity match.
    """
    item_terms = item_words(items, item_id, item_text, window)
    index = build_index(docs, item_terms, id_col, text_col)
    matches = stored(phrase_matches(index, item_terms), "matches")
    ids = item_terms.select("item", "item_id").distinct()
    listed = (matches.select("uid", "item").distinct().join(ids, "item").groupBy("uid")
              .agg(F.array_sort(F.collect_set("item_id")).alias("found")))
    none = F.array().cast("array<string>")
    result = index.where("word = ''").join(covered(matches), "uid", "left").join(listed, "uid", "left")
    extra = []
    if distance is not None:
        near = (near_matches(index, item_terms, distance).select("uid", "item").distinct().join(ids, "item")
                .groupBy("uid").agg(F.count_distinct("item_id").alias("n_near")))
        result, extra = result.join(near, "uid", "left"), [F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")]
    return result.select(
        F.col("id").alias(id_col), F.col("pos").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("found", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("found", none), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), "text_hash", *extra)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    bad = stored(contamination(docs, items, id_col, text_col, **options).where("contaminated")
                 .select(F.col(f"`{id_col}`").alias("_id"), F.col("text_hash").alias("_hash")).distinct(),
                 "contaminated")
    same = named(id_col).eqNullSafe(bad["_id"]) & (F.xxhash64(body(text_col)) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
