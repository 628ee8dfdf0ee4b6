"""Text functions over the review texts, the documents and the pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.functions import rules
from reviewlake.functions import text as txt
from reviewlake.queries import query, rows_total
from reviewlake.queries.dashboards import SCORE_TENTHS, SCORED_NEG, SCORED_POS, TENTHS, _CATS
from reviewlake.queries.fixtures import (
    PHRASES, anonymized_sql, flag_sql, hits_sql, label_sql, on_reviews, on_silver, reviews, silver, sql_text,
    table, types_sql, with_ctes,
)

@query("sentiment_label", on_reviews(f"""
  SELECT review_text, {label_sql("review_text")} AS sentimento, count(*) AS total FROM reviews GROUP BY ALL
"""))
def _(spark, sf_dir):
    labelled = reviews(spark, sf_dir).select(
        "review_text", txt.sentiment_label(F.col("review_text")).alias("sentimento"))
    return labelled.groupBy("review_text", "sentimento").agg(rows_total())


@query("sentiment_label_documents", f"""
  SELECT doc_id, {hits_sql("text", rules.POSITIVE_TERMS)} AS positivas,
    {hits_sql("text", rules.NEGATIVE_TERMS)} AS negativas, {label_sql("text")} AS sentimento FROM documents
""")
def _(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", txt.count_terms(text, rules.POSITIVE_TERMS).alias("positivas"),
        txt.count_terms(text, rules.NEGATIVE_TERMS).alias("negativas"),
        txt.sentiment_label(text).alias("sentimento"))


# Terms of several words hide the shorter terms inside them.
_LONG = [t for t in rules.NEGATIVE_TERMS if " " in t]


def _tokens_sql(terms) -> str:
    def whole(column, term):
        return (rf"CASE WHEN regexp_matches({column}, '(^|[^\p{{L}}\p{{N}}_]){term}([^\p{{L}}\p{{N}}_]|$)') "
                "THEN 1 ELSE 0 END")

    return " + ".join(whole("low" if t in _LONG else "rest", t) for t in terms)


@query("sentiment_label_tokens", on_reviews(f"""
  , r AS (SELECT review_text, lower(review_text) AS low,
      regexp_replace(lower(review_text), '{"|".join(_LONG)}', '#', 'g') AS rest FROM reviews),
  n AS (SELECT review_text, {_tokens_sql(rules.POSITIVE_TERMS)} AS p, {_tokens_sql(rules.NEGATIVE_TERMS)} AS n FROM r)
  SELECT review_text, CASE WHEN p > n THEN 'positivo' WHEN n > p THEN 'negativo' ELSE 'neutro' END AS sentimento,
    count(*) AS total FROM n GROUP BY ALL
"""))
def _(spark, sf_dir):
    label = txt.sentiment_label(F.col("review_text"), mode="token")
    return reviews(spark, sf_dir).groupBy("review_text", label.alias("sentimento")).agg(
        rows_total())


@query("sentiment_score", on_silver(f"""
  SELECT texto_review, CASE WHEN length(trim(texto_review)) < 3 THEN 'NEUTRO'
      WHEN {SCORED_POS} > {SCORED_NEG} THEN 'POSITIVO' WHEN {SCORED_NEG} > {SCORED_POS} THEN 'NEGATIVO'
      ELSE 'NEUTRO' END AS label, ({SCORE_TENTHS})::DOUBLE / 10.0::DOUBLE AS score, count(*) AS total
  FROM silver GROUP BY ALL
"""))
def _(spark, sf_dir):
    scored = silver(spark, sf_dir).withColumn("s", txt.sentiment_score(F.col("texto_review")))
    return scored.groupBy(
        "texto_review", F.col("s.label").alias("label"), F.col("s.score").alias("score")
    ).agg(rows_total())


@query("pii_types_documents", f"""
  SELECT doc_id, source, {types_sql("text")} AS tipos,
    CASE WHEN {types_sql("text")} = '' THEN 'NENHUM' ELSE upper({types_sql("text")}) END AS tipos_str
  FROM documents
""")
def _(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", txt.pii_types(text).alias("tipos"), txt.pii_types_str(text).alias("tipos_str"))


@query("pii_by_source", f"""
  SELECT source, lang, count(*) AS total, count(*) FILTER ({flag_sql("text", rules.EMAIL_PATTERN)}) AS com_email,
    count(*) FILTER ({flag_sql("text", rules.PHONE_PATTERN)}) AS com_telefone
  FROM documents GROUP BY ALL
""")
def _(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("tipos", txt.pii_types(F.col("text")))
    return d.groupBy("source", "lang").agg(
        rows_total(), F.count_if(F.array_contains("tipos", "email")).alias("com_email"),
        F.count_if(F.array_contains("tipos", "telefone")).alias("com_telefone"))


@query("anonymize_documents", f"SELECT doc_id, md5({anonymized_sql('text')}) AS texto_md5 FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(txt.anonymize(F.col("text"))).alias("texto_md5"))


@query("anonymize_conversations", f"""
  SELECT conv_id, turn, role, {types_sql("text")} AS tipos, md5({anonymized_sql('text')}) AS texto_md5 FROM conversations
""")
def _(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", txt.pii_types(text).alias("tipos"),
        F.md5(txt.anonymize(text)).alias("texto_md5"))


def _masked(column: str) -> str:
    for _, pattern, token in rules.MASK_RULES:
        column = f"regexp_replace({column}, {sql_text(pattern)}, '{token}', 'g')"
    return column


@query("mask_pii_documents", f"SELECT doc_id, md5({_masked('text')}) AS texto_md5 FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(txt.mask_pii(F.col("text"))).alias("texto_md5"))


@query("mask_pii_reviews", on_reviews(f"""
  SELECT {_masked('review_text')} AS mascarado, count(*) AS total FROM reviews GROUP BY ALL
"""))
def _(spark, sf_dir):
    return reviews(spark, sf_dir).groupBy(
        txt.mask_pii(F.col("review_text")).alias("mascarado")).agg(rows_total())


@query("reputational_risk", on_silver(f"""
  , r AS (SELECT texto_review, {TENTHS} AS d, concat_ws(',', {", ".join(
      f"CASE WHEN {h} > 0 THEN '{n}' END" for n, h in _CATS.items())}) AS cats FROM silver)
  SELECT texto_review, CASE WHEN d >= 20 THEN 'ALTO' WHEN d >= 10 THEN 'MEDIO' WHEN d > 0 THEN 'BAIXO'
    ELSE 'NENHUM' END AS nivel, CASE WHEN cats = '' THEN 'NENHUMA' ELSE cats END AS categorias,
    d::DOUBLE / 10.0::DOUBLE AS score, count(*) AS total
  FROM r GROUP BY ALL
"""))
def _(spark, sf_dir):
    risky = silver(spark, sf_dir).select(
        "texto_review", F.inline(F.array(txt.reputational_risk(F.col("texto_review")))))
    return risky.groupBy("texto_review", "nivel", "categorias", "score").agg(rows_total())


@query("critical_patterns", on_silver(f"""
  SELECT texto_review, concat_ws(',', {", ".join(
      f"CASE WHEN regexp_matches(texto_review, {sql_text(p)}, 'i') THEN '{n}' END"
      for n, p in rules.CRITICAL_PATTERNS)}) AS padroes, count(*) AS total
  FROM silver GROUP BY ALL
"""))
def _(spark, sf_dir):
    found = silver(spark, sf_dir).select(
        "texto_review", F.array_join(txt.critical_patterns(F.col("texto_review")), ",").alias("padroes"))
    return found.groupBy("texto_review", "padroes").agg(rows_total())


# Whole documents and turns, each with one of the review texts after it.
LONG_SQL = f"""
  phrases(phrase_id, phrase) AS (VALUES {", ".join(f"({i}, {sql_text(p)})" for i, p in enumerate(PHRASES))}),
  long AS (
    SELECT doc_id AS id, 0 AS turn, concat_ws(' ', text, phrase) AS texto_review
    FROM documents JOIN phrases ON doc_id % 24 = phrase_id
    UNION ALL SELECT conv_id, CAST(turn AS INT) + 1, concat_ws(' ', text, phrase)
    FROM conversations JOIN phrases ON (conv_id + turn) % 24 = phrase_id)
"""


def long_texts(spark, sf_dir):
    def with_phrase(name, number, id_col, turn):
        phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), (number % 24).cast("int"))
        return table(spark, sf_dir, name).select(
            F.col(id_col).alias("id"), turn.cast("int").alias("turn"), F.concat_ws(" ", "text", phrase).alias("texto_review"))

    return with_phrase("documents", F.col("doc_id"), "doc_id", F.lit(0)).unionByName(
        with_phrase("conversations", F.col("conv_id") + F.col("turn"), "conv_id", F.col("turn") + 1))


@query("sentiment_score_long", with_ctes(LONG_SQL, f"""
  SELECT id, turn, CASE WHEN length(trim(texto_review)) < 3 THEN 'NEUTRO'
      WHEN {SCORED_POS} > {SCORED_NEG} THEN 'POSITIVO' WHEN {SCORED_NEG} > {SCORED_POS} THEN 'NEGATIVO'
      ELSE 'NEUTRO' END AS label, ({SCORE_TENTHS})::DOUBLE / 10.0::DOUBLE AS score
  FROM long
"""))
def _(spark, sf_dir):
    scored = long_texts(spark, sf_dir).withColumn("s", txt.sentiment_score(F.col("texto_review")))
    return scored.select("id", "turn", F.col("s.label").alias("label"), F.col("s.score").alias("score"))


@query("reputational_risk_long", with_ctes(LONG_SQL, f"""
  , r AS (SELECT id, turn, {TENTHS} AS d, concat_ws(',', {", ".join(
      f"CASE WHEN {h} > 0 THEN '{n}' END" for n, h in _CATS.items())}) AS cats FROM long)
  SELECT id, turn, CASE WHEN d >= 20 THEN 'ALTO' WHEN d >= 10 THEN 'MEDIO' WHEN d > 0 THEN 'BAIXO'
    ELSE 'NENHUM' END AS nivel, CASE WHEN cats = '' THEN 'NENHUMA' ELSE cats END AS categorias,
    d::DOUBLE / 10.0::DOUBLE AS score
  FROM r
"""))
def _(spark, sf_dir):
    return long_texts(spark, sf_dir).select(
        "id", "turn", F.inline(F.array(txt.reputational_risk(F.col("texto_review"))))).select(
        "id", "turn", "nivel", "categorias", "score")


@query("critical_patterns_long", with_ctes(LONG_SQL, f"""
  SELECT id, turn, concat_ws(',', {", ".join(
      f"CASE WHEN regexp_matches(texto_review, {sql_text(p)}, 'i') THEN '{n}' END"
      for n, p in rules.CRITICAL_PATTERNS)}) AS padroes
  FROM long
"""))
def _(spark, sf_dir):
    return long_texts(spark, sf_dir).select(
        "id", "turn", F.array_join(txt.critical_patterns(F.col("texto_review")), ",").alias("padroes"))


_SP = r"\t\n\x0b\f\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _cleaned(column: str) -> str:
    steps = (
        (rf"[^\p{{L}}\p{{N}}_{_SP}.!?,;:\-]", " "),
        (rf"[{_SP}]+", " "),
        (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+", ""),
        (rf"[^{_SP}]+@[^{_SP}]+", "[EMAIL]"),
        (rf"^[{_SP}]+|[{_SP}]+$", ""),
    )
    for pattern, replacement in steps:
        column = f"regexp_replace({column}, {sql_text(pattern)}, '{replacement}', 'g')"
    return column


@query("clean_text_documents", f"SELECT doc_id, md5({_cleaned('text')}) AS limpo_md5 FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(txt.clean_text(F.col("text"))).alias("limpo_md5"))


@query("clean_text_pages", f"""
  SELECT page_id, md5({_cleaned('html')}) AS limpo_md5, {_cleaned('url')} AS url_limpa FROM pages
""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(txt.clean_text(F.col("html"))).alias("limpo_md5"),
        txt.clean_text(F.col("url")).alias("url_limpa"))


@query("anonymize_author", """
  SELECT c_custkey, upper(left(c_name, 1)) || '***' || left(md5(c_name), 6) AS autor FROM customer
""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", txt.anonymize_author(F.col("c_name")).alias("autor"))


@query("pseudonymize", """
  SELECT c_custkey, 'AUTOR_' || upper(left(sha256(trim(lower(c_name)) || 'sal-de-teste'), 8)) AS autor
  FROM customer
""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", txt.pseudonymize(F.col("c_name"), "sal-de-teste").alias("autor"))


@query("silver_strict_privacy", on_silver("""
  SELECT place_id, 'AUTOR_' || upper(left(sha256(trim(lower(review_autor)) || 'sal-de-teste'), 8)) AS review_autor,
    texto_anonimizado AS texto_review, count(*) AS total
  FROM silver GROUP BY ALL
"""))
def _(spark, sf_dir):
    strict = silver(spark, sf_dir, privacy="strict", salt="sal-de-teste")
    return strict.groupBy("place_id", "review_autor", "texto_review").agg(rows_total())


@query("slug_and_title", """
  SELECT p_partkey, replace(lower(p_type || ' ' || p_name), ' ', '_') AS slug,
    array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS titulo
  FROM part
""")
def _(spark, sf_dir):
    both = F.concat_ws(" ", "p_type", "p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", txt.slug(both).alias("slug"), txt.unslug(txt.slug(F.col("p_type"))).alias("titulo"))


@query("scalar_basics", """
  SELECT c_custkey, lower(trim('  ' || c_name || ' ')) AS nome, CAST(length(c_name) AS INT) AS tamanho,
    c_name || '-' || CAST(c_custkey AS VARCHAR) AS rotulo, c_mktsegment LIKE '%BUILD%' AS construcao,
    round(CAST(c_acctbal AS DECIMAL(20,4)), 1)::DOUBLE AS saldo,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, c_acctbal / 10000.0)) AS saldo01
  FROM customer
""")
def _(spark, sf_dir):
    from reviewlake.functions.numeric import clamp01, round_exact

    name, balance = F.col("c_name"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.lower(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("nome"),
        F.length(name).alias("tamanho"),
        F.concat(name, F.lit("-"), F.col("c_custkey").cast("string")).alias("rotulo"),
        F.col("c_mktsegment").like("%BUILD%").alias("construcao"),
        round_exact(balance, 1).alias("saldo"), clamp01(balance / 10000.0).alias("saldo01"))


@query("date_basics", """
  SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes,
    strftime(o_orderdate, '%Y-%m') AS ano_mes, CAST(year(o_orderdate) AS INT) AS ano,
    CAST(day(o_orderdate) AS INT) AS dia,
    strftime(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY, '%Y-%m-%d') AS antes_30d,
    strftime(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH, '%Y-%m-%d') AS antes_12m,
    TRY_CAST(o_orderstatus AS DATE) IS NULL AS data_invalida
  FROM orders
""")
def _(spark, sf_dir):
    from reviewlake.functions import dates

    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.month_start(text).alias("mes"), dates.year_month(text).alias("ano_mes"),
        F.year(day).alias("ano"), F.dayofmonth(day).alias("dia"),
        (day - dates.interval("30 days")).cast("date").alias("antes_30d"),
        (day - dates.interval("12 months")).cast("date").alias("antes_12m"),
        dates.to_date_or_null(F.col("o_orderstatus")).isNull().alias("data_invalida"))


@query("array_basics", """
  SELECT c_custkey, CAST(len(string_split(c_name, '#')) AS INT) AS partes,
    string_split(c_name, '#')[1] AS primeira, array_to_string(string_split(c_name, '#')[1:2], '/') AS fatia,
    u.x AS parte
  FROM customer, unnest(string_split(c_name, '#')) AS u(x)
""")
def _(spark, sf_dir):
    parts = F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.size(parts).alias("partes"), F.get(parts, F.lit(0)).alias("primeira"),
        F.array_join(F.slice(parts, 1, 2), "/").alias("fatia"), F.explode(parts).alias("parte"))


@query("sentiment_text_sql_function", on_reviews(f"""
  SELECT {label_sql("review_text")} AS sentimento, {anonymized_sql("review_text")} AS anonimo, count(*) AS total
  FROM reviews WHERE review_text IS NOT NULL GROUP BY ALL
"""))
def _(spark, sf_dir):
    from reviewlake.functions.sqlfunctions import register_functions

    register_functions(spark)
    view = reviews(spark, sf_dir).filter("review_text IS NOT NULL").select("review_text")
    return spark.sql(
        "SELECT sentimento_ptbr(review_text) AS sentimento, anonimizar(review_text) AS anonimo, "
        "count(*) AS total FROM {r} GROUP BY ALL", r=view)
