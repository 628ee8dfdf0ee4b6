"""Portuguese review analytics as ``Column -> Column`` functions.

Everything is a built-in expression, so scans still prune columns. Term counts and
labels are generated code; functions that bind a value in a lambda (the scored
sentiment, risk as one struct) are interpreted inside it.
"""

from __future__ import annotations

import re
from functools import cache, reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import rules

# White space and word characters spelled out, so that matching does not depend
# on a regex engine's idea of \s and \w.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _unicode(pattern: str) -> str:
    return "(?U)" + pattern


def replace_all(text: Column, pattern: str, token: str) -> Column:
    return F.regexp_replace(text, _unicode(pattern), token)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


# --- sentiment ---------------------------------------------------------------

def count_in_lowered(lowered: Column, terms) -> Column:
    """How many of ``terms`` occur in an already lower-cased text; NULL counts 0.

    A balanced sum of one test per term: generated code throughout, where a filter
    over an array of terms would be interpreted. Terms that share a piece are tested
    only where that piece occurs.
    """
    def found(term: str) -> Column:
        return F.contains(lowered, F.lit(term)).cast("int")

    tests = [found(some[0]) if len(some) == 1 else
             F.when(F.contains(lowered, F.lit(piece)), _balanced_sum([found(t) for t in some])).otherwise(F.lit(0))
             for piece, some in by_piece(tuple(terms))]
    return F.coalesce(_balanced_sum(tests), F.lit(0)) if tests else F.lit(0)


def _balanced_sum(terms: list[Column]) -> Column:
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) & ~1:]
    return terms[0]


@cache
def by_piece(terms: tuple[str, ...], least: int = 3) -> list[tuple[str, list[str]]]:
    """The terms in groups with a piece that all of a group contain: always the piece of most terms left, then the longest."""
    groups, left = [], list(terms)
    while left:
        owners: dict[str, list[str]] = {}
        for term in left:
            for piece in {term[i:j] for i in range(len(term)) for j in range(i + least, len(term) + 1)} or {term}:
                owners.setdefault(piece, []).append(term)
        piece = max(owners, key=lambda p: (len(owners[p]), len(p), p))
        some = owners[piece]
        groups.append((piece, some))
        left = [t for t in left if piece not in t] if len(piece) >= least else [t for t in left if t not in some]
    return groups


def _bind(value: Column, build) -> Column:
    """``build`` applied to ``value`` as a bound variable: the value is computed once
    however often the result uses it, also inside a pushed-down filter."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _with_lowered(text: Column, build) -> Column:
    return _bind(F.lower(text), build)


def count_terms(text: Column, terms) -> Column:
    return count_in_lowered(F.lower(text), terms)


def _token_hits(text: Column, terms, others) -> Column:
    every = sorted({*terms, *others}, key=len, reverse=True)
    pattern = rf"(?U)(?<!\w)({'|'.join(re.escape(t) for t in every)})(?!\w)"
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
    wanted = F.array(*[F.lit(t) for t in terms])
    return F.coalesce(F.size(F.array_intersect(found, wanted)), F.lit(0))


def sentiment_side(text: Column, positive, negative, mode: str = "substring") -> Column:
    """1, -1 or 0: which list has more terms in the text.

    The counts of ``substring`` are used twice, so Spark computes each once and in a method
    of its own; in one method with the other columns of Silver they would be too large for
    the JVM to compile.
    """
    if mode == "substring":
        low = F.lower(text)
        pos, neg = count_in_lowered(low, positive), count_in_lowered(low, negative)
        return (pos > neg).cast("int") - (neg > pos).cast("int")
    if mode == "token":
        return F.signum(_token_hits(text, positive, negative) - _token_hits(text, negative, positive)).cast("int")
    raise ValueError(f"unknown sentiment mode {mode!r}")


def sentiment_label(text: Column, positive=rules.POSITIVE_TERMS, negative=rules.NEGATIVE_TERMS,
                    mode: str = "substring") -> Column:
    """positivo / negativo / neutro by which list has more terms in the text.

    ``mode="substring"`` counts terms wherever they occur, also inside longer
    words; ``mode="token"`` wants whole words and lets the longest term win.
    """
    side = sentiment_side(text, positive, negative, mode)
    return F.elt(side + F.lit(2), F.lit("negativo"), F.lit("neutro"), F.lit("positivo"))


def sentiment_score(text: Column, positive=rules.SCORED_POSITIVE_TERMS,
                    negative=rules.SCORED_NEGATIVE_TERMS) -> Column:
    """struct<label, score>: the winning side's 0.5 + 0.1 per term, at most 0.9."""
    counts = _with_lowered(text, lambda low: F.struct(
        count_in_lowered(low, positive).alias("pos"), count_in_lowered(low, negative).alias("neg"),
        (F.coalesce(F.length(strip(low)), F.lit(0)) >= 3).alias("long"),
    ))

    def scored(c):
        ahead, behind = c["long"] & (c["pos"] > c["neg"]), c["long"] & (c["neg"] > c["pos"])
        tenths = F.least(F.lit(9), F.greatest(c["pos"], c["neg"]) + F.lit(5))
        return F.struct(
            F.when(ahead, F.lit("POSITIVO")).when(behind, F.lit("NEGATIVO"))
            .otherwise(F.lit("NEUTRO")).alias("label"),
            F.when(ahead | behind, tenths.cast("double") / F.lit(10.0)).otherwise(F.lit(0.5))
            .alias("score"),
        )

    return _bind(counts, scored)


def with_sentiment_tenths(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the score of ``sentiment_score`` in tenths as a long.

    In successive projections rather than bound variables: columns that the next
    projection uses more than once are kept apart, and all of it is generated code.
    """
    counted = df.withColumn("_low", F.lower(text)).withColumns({
        "_pos": count_in_lowered(F.col("_low"), rules.SCORED_POSITIVE_TERMS),
        "_neg": count_in_lowered(F.col("_low"), rules.SCORED_NEGATIVE_TERMS),
        "_long": F.coalesce(F.length(strip(F.col("_low"))), F.lit(0)) >= 3,
    })
    decided = F.col("_long") & (F.col("_pos") != F.col("_neg"))
    tenths = F.when(decided, F.least(F.lit(9), F.greatest("_pos", "_neg") + F.lit(5))).otherwise(F.lit(5))
    return counted.withColumn(name, tenths.cast("bigint")).drop("_low", "_pos", "_neg", "_long")


# --- personal data -----------------------------------------------------------

def _matches(text: Column, kind: str, pattern: str) -> Column:
    found = text.rlike(_unicode(pattern))
    if kind == "email":
        # A plain byte search spares most texts the regex.
        found = text.contains("@") & found
    return found


def pii_flags(text: Column, table=rules.PII_RULES) -> dict[str, Column]:
    return {kind: F.coalesce(_matches(text, kind, p), F.lit(False)) for kind, p, _ in table}


def types_from_flags(flags: dict[str, Column]) -> Column:
    marks = F.array(*[F.when(f, F.lit(kind)) for kind, f in flags.items()])
    none = F.array().cast("array<string>")
    # array_except drops the NULLs inside generated code, where array_compact could not.
    found = F.array_except(marks, F.array(F.lit(None).cast("string")))
    return F.when(any_flag(flags), found).otherwise(none)


def any_flag(flags: dict[str, Column]) -> Column:
    return reduce(or_, flags.values())


def anonymize_with_flags(text: Column, flags: dict[str, Column], table=rules.PII_RULES) -> Column:
    """Replace each detected type in turn; detection looked at the original text."""
    result = text
    for kind, pattern, token in table:
        result = F.when(flags[kind], replace_all(result, pattern, token)).otherwise(result)
    return result


def pii_types(text: Column) -> Column:
    """array<string> of cpf / email / telefone found in the text."""
    return types_from_flags(pii_flags(text))


def has_pii(text: Column) -> Column:
    return any_flag(pii_flags(text))


def anonymize(text: Column) -> Column:
    return anonymize_with_flags(text, pii_flags(text))


def pii_types_str(text: Column) -> Column:
    joined = F.upper(F.array_join(pii_types(text), ","))
    return F.when(joined == "", F.lit("NENHUM")).otherwise(joined)


def mask_pii(text: Column) -> Column:
    """Mask CPF, phone, e-mail and postal code, each on the result of the one before."""
    result = text
    for kind, pattern, token in rules.MASK_RULES:
        replaced = replace_all(result, pattern, token)
        result = F.when(result.contains("@"), replaced).otherwise(result) if kind == "email" else replaced
    return result


def anonymize_author(name: Column) -> Column:
    shown = F.concat(F.upper(F.substring(name, 1, 1)), F.lit("***"), F.substring(F.md5(name), 1, 6))
    return F.when(is_blank(name), F.lit("Anônimo")).otherwise(shown)


def pseudonymize(name: Column, salt: str) -> Column:
    """A stable AUTOR_ code per author; the salt is the caller's secret."""
    digest = F.sha2(F.concat(strip(F.lower(name)), F.lit(salt)), 256)
    code = F.concat(F.lit("AUTOR_"), F.upper(F.substring(digest, 1, 8)))
    return F.when(name.isNull() | (name == ""), F.lit("ANONIMO")).otherwise(code)


# --- reputational risk -------------------------------------------------------

def risk_matches(text: Column) -> Column:
    """struct of matching keywords per category."""
    return _with_lowered(text, lambda low: F.struct(*[
        count_in_lowered(low, words).alias(name) for name, _, words in rules.RISK_CATEGORIES]))


def _by_category(matches: Column) -> dict[str, Column]:
    return {name: matches[name] for name, _, _ in rules.RISK_CATEGORIES}


def risk_names(counts: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(n > 0, F.lit(name)) for name, n in counts.items()]))


def risk_categories(text: Column) -> Column:
    return _bind(risk_matches(text), lambda m: risk_names(_by_category(m)))


def risk_keyword_pairs(text: Column) -> Column:
    """array<struct<tipo_risco, palavra>> of every keyword found, with its category."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("tipo_risco"), F.lit(word).alias("palavra"))
        for name, _, words in rules.RISK_CATEGORIES for word in words
    ])
    return _with_lowered(
        text, lambda low: F.filter(pairs, lambda pair: F.contains(low, pair["palavra"])))


def weighted_tenths(counts: dict[str, Column]) -> Column:
    """Weighted matches in tenths: integer, so level borders are exact."""
    weights = {name: weight for name, weight, _ in rules.RISK_CATEGORIES}
    return reduce(add, [n * F.lit(weights[name]) for name, n in counts.items()])


def risk_tenths(text: Column) -> Column:
    return _bind(risk_matches(text), lambda m: weighted_tenths(_by_category(m)))


def risk_level(tenths: Column) -> Column:
    return (
        F.when(tenths >= 20, F.lit("ALTO")).when(tenths >= 10, F.lit("MEDIO"))
        .when(tenths > 0, F.lit("BAIXO")).otherwise(F.lit("NENHUM"))
    )


def reputational_risk(text: Column) -> Column:
    """struct<nivel, categorias, score>."""
    summed = _bind(risk_matches(text), lambda m: F.struct(
        weighted_tenths(_by_category(m)).alias("tenths"),
        F.array_join(risk_names(_by_category(m)), ",").alias("names")))
    return _bind(summed, lambda r: F.struct(
        risk_level(r["tenths"]).alias("nivel"),
        F.when(r["names"] == "", F.lit("NENHUMA")).otherwise(r["names"]).alias("categorias"),
        (r["tenths"].cast("double") / F.lit(10.0)).alias("score")))


def critical_patterns(text: Column) -> Column:
    return F.array_compact(F.array(*[
        F.when(text.rlike("(?iuU)" + pattern), F.lit(name))
        for name, pattern in rules.CRITICAL_PATTERNS
    ]))


# --- clean-up and names ------------------------------------------------------

def clean_text(text: Column, faithful: bool = True) -> Column:
    """Strip special characters, collapse spaces, drop URLs, mark e-mails, trim.

    The faithful order strips special characters first, which takes the "@" and
    "/" the later steps look for; ``faithful=False`` runs those steps first.
    """
    def plain(c):
        # A special character becomes a space, and a run of spaces one: both in one pass.
        return F.regexp_replace(c, rf"[^{WORD_CLASS}.!?,;:\-]+", " ")

    def urls(c):
        # One class covers every alternative of the documented URL pattern.
        return F.when(c.contains("://"), F.regexp_replace(c, r"https?://[!$-_a-z]+", "")).otherwise(c)

    def emails(c, token):
        # A match can only start where a run of non-space starts.
        run = rf"[^{SPACE_CLASS}]"
        return F.when(c.contains("@"), F.regexp_replace(c, rf"(?<!{run}){run}+@{run}+", token)).otherwise(c)

    source = F.coalesce(text, F.lit(""))
    if faithful:
        # Without "@" and "/", which are special, the later steps find nothing to do.
        result = emails(urls(plain(source)), "[EMAIL]")
    else:
        result = plain(emails(urls(source), "EMAIL"))
    return strip(result)


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def unslug(name: Column) -> Column:
    """Title case after turning underscores into spaces; every non-letter starts a word."""
    pieces = F.split(F.lower(F.replace(name, F.lit("_"), F.lit(" "))), r"(?<=\P{L})")
    return F.array_join(F.transform(pieces, F.initcap), "")
