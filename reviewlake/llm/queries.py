"""The registered queries of this package and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import (
    bpe, decontam, exact_dedup, hard_negatives, langid, lines, merkle, pseudo_likelihood, rans, secrets, simhash,
    token_cache, warc,
)
from reviewlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("uid")


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op3_warc", """
    WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    sized AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM page),
    first AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM sized)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
    FROM first""")
def op3_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages")).drop("url")


@query("op4_line_dedup", """
    WITH line AS (
        SELECT doc_id, source, i, lines[i] AS line
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines,
                     unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
    common AS (SELECT trim(line) AS t FROM line WHERE length(trim(line)) >= 20
               GROUP BY 1 HAVING count(DISTINCT source) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(common.t) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.t IS NULL), '') AS clean_text
    FROM line LEFT JOIN common ON trim(line) = common.t GROUP BY doc_id""")
def op4_line_dedup(spark, sf_dir):
    return lines.remove_boilerplate(table(spark, sf_dir, "documents"))


@query("op5_rans")
def op5_rans(spark, sf_dir):
    return rans.written_and_read(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return token_cache.token_counts(table(spark, sf_dir, "documents"))


@query("op7_decontamination", r"""
    WITH item AS (
        SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
        FROM benchmark),
    sized AS (SELECT item_id, w, least(10, len(w)) AS need FROM item WHERE len(w) > 0),
    win AS (
        SELECT DISTINCT item_id, need, unnest([array_to_string(w[s:s + need - 1], ' ') for s in range(1, len(w) - need + 2)]) AS g
        FROM sized),
    doc AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
        FROM documents),
    gram AS (
        SELECT doc_id, need, s, array_to_string(w[s:s + need - 1], ' ') AS g
        FROM (SELECT doc_id, w, need, unnest(range(1, len(w) - need + 2)) AS s
              FROM doc, (SELECT DISTINCT need FROM sized))),
    met AS (SELECT doc_id, need, s, item_id FROM gram JOIN win USING (need, g)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + need)) AS p FROM met) GROUP BY doc_id),
    found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
              FROM met GROUP BY doc_id),
    posting AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM doc),
    tf AS (SELECT word, count(*) AS n FROM posting GROUP BY word),
    passage AS (SELECT item_id, w, need, unnest(list_distinct(list_append(range(0, len(w) - need + 1, need), len(w) - need))) AS s
                FROM sized),
    term AS (SELECT DISTINCT item_id, w, s, word
             FROM (SELECT item_id, w, s, unnest(w[s + 1:s + need]) AS word FROM passage)),
    ranked AS (SELECT item_id, w, s, word, n, row_number() OVER (PARTITION BY item_id, w, s ORDER BY n NULLS LAST, word) AS r,
                      greatest(2, (4 * count(*) OVER (PARTITION BY item_id, w, s) + 4) // 5) AS required
               FROM term LEFT JOIN tf USING (word)),
    pair AS (SELECT item_id, w, s, a.word AS w1, b.word AS w2, a.required
             FROM (SELECT * FROM ranked WHERE r = 1) a JOIN (SELECT * FROM ranked WHERE r = 2 AND n IS NOT NULL) b
             USING (item_id, w, s)),
    close AS (SELECT DISTINCT p.doc_id, p.pos, item_id, w, s, required
              FROM pair JOIN posting p ON p.word = w1
              JOIN posting q ON q.doc_id = p.doc_id AND q.word = w2 AND q.pos BETWEEN p.pos - 20 AND p.pos + 20),
    around AS (SELECT c.doc_id, c.item_id
               FROM close c JOIN term t ON t.item_id = c.item_id AND t.w = c.w AND t.s = c.s
               JOIN posting q ON q.doc_id = c.doc_id AND q.word = t.word AND q.pos BETWEEN c.pos - 20 AND c.pos + 20
               GROUP BY c.doc_id, c.item_id, c.w, c.s, c.pos, c.required HAVING count(DISTINCT q.word) >= c.required),
    near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM around GROUP BY doc_id)
    SELECT doc_id, coalesce(n_near, 0) AS n_near, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)""")
def op7_decontamination(spark, sf_dir):
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                   distance=decontam.DISTANCE)
    return found.drop("text_hash")


@query("op8_bpe_chunks")
def op8_bpe_chunks(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


@query("op9_simhash")
def op9_simhash(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op10_pseudo_likelihood")
def op10_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood.score_corpus(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", """
    WITH given AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM given a JOIN given b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positive AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id,
           positive_score, score AS negative_score
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
    QUALIFY row_number() OVER w <= 10""")
def op11_hard_negatives(spark, sf_dir):
    rows = hard_negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


@query("op12_secrets")
def op12_secrets(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op13_merkle", r"""
    WITH RECURSIVE coded AS (
        SELECT *, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                   lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
                                            lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS inverted
        FROM documents),
    field AS (
        SELECT doc_id, source, xor(inverted, 4294967295) % 5 = 0 AS hit, text,
               coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
        FROM coded),
    hashed AS (
        SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text,
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS altered
        FROM field),
    leaf AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
        FROM hashed),
    node AS (
        SELECT tree, n, 0 AS level, i, leaf AS h FROM leaf
        UNION ALL
        SELECT tree, CAST(ceil(n / 16.0) AS BIGINT), level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
        FROM node WHERE n > 1 GROUP BY tree, n, level, i // 16),
    subroot AS (SELECT tree, h, count(*) OVER () AS n FROM node WHERE n = 1),
    upper AS (
        SELECT n, 0 AS level, tree AS i, h FROM subroot
        UNION ALL
        SELECT CAST(ceil(n / 16.0) AS BIGINT), level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
        FROM upper WHERE n > 1 GROUP BY n, level, i // 16),
    beside AS (
        SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
               coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
        FROM node a JOIN node b ON a.tree = b.tree AND a.level = b.level AND a.i // 16 = b.i // 16
        WHERE a.n > 1 GROUP BY a.tree, a.level, a.i
        UNION ALL
        SELECT -1, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), ''),
               coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '')
        FROM upper a JOIN upper b ON a.level = b.level AND a.i // 16 = b.i // 16
        WHERE a.n > 1 GROUP BY a.level, a.i),
    path AS (
        SELECT leaf.tree, leaf.i, list(struct_pack(l := b.l, r := b.r) ORDER BY b.tree DESC, b.level) AS p
        FROM leaf JOIN beside b ON b.tree = leaf.tree AND b.i = leaf.i // CAST(pow(16, b.level) AS BIGINT)
                             OR b.tree = -1 AND b.i = leaf.tree // CAST(pow(16, b.level) AS BIGINT)
        GROUP BY leaf.tree, leaf.i)
    SELECT doc_id, leaf, s.h AS subroot, root.h AS root,
           sha256(list_aggregate(list_prepend('', list_transform(p, lambda x: x.l || x.r)), 'string_agg', '')) AS proof_sha256,
           list_reduce(list_prepend(struct_pack(l := coalesce(altered, leaf), r := ''), coalesce(p, [])),
                       lambda acc, x: struct_pack(l := sha256(x.l || acc.l || x.r), r := '')).l AS folded_root,
           folded_root = root.h AS verified
    FROM leaf JOIN subroot s USING (tree) CROSS JOIN (SELECT h FROM upper WHERE n = 1) root
         LEFT JOIN path ON path.tree = leaf.tree AND path.i = leaf.i""")
def op13_merkle(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
