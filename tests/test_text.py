"""Text functions on the phrase fixture and on edge cases."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake.functions import rules
from reviewlake.functions import text as txt
from reviewlake.functions.sqlfunctions import register_functions
from reviewlake.operators.silver import enrich
from reviewlake.queries.fixtures import PHRASES

# phrase -> (label, types, anonymised text where it differs)
EXPECTED = {
    0: ("positivo", [], None), 1: ("negativo", [], None), 2: ("neutro", [], None),
    3: ("neutro", [], None), 4: ("negativo", [], None), 5: ("negativo", [], None),
    6: ("neutro", [], None), 7: ("positivo", [], None), 8: ("neutro", [], None),
    9: ("neutro", [], None), 10: ("neutro", [], None), 11: ("neutro", [], None),
    12: ("neutro", ["cpf"], "Meu CPF [CPF_ANONIMIZADO] foi exposto"),
    13: ("neutro", ["telefone"], "Ligue [TELEFONE_ANONIMIZADO]"),
    14: ("neutro", ["cpf", "telefone"], "Ligue [CPF_ANONIMIZADO]"),
    15: ("neutro", ["email"], "Contato: [EMAIL_ANONIMIZADO]"),
    16: ("neutro", ["cpf", "email", "telefone"],
         "CPF [CPF_ANONIMIZADO], email [EMAIL_ANONIMIZADO], tel [TELEFONE_ANONIMIZADO]"),
    17: ("negativo", [], None), 18: ("neutro", [], None), 19: ("neutro", [], None),
    20: ("neutro", [], None), 21: ("positivo", [], None), 22: ("positivo", [], None),
    23: ("neutro", [], None),
}


@pytest.fixture(scope="module")
def phrases(spark):
    return spark.createDataFrame(list(enumerate(PHRASES)), "id int, t string")


def values(df, expr):
    return {r[0]: r[1] for r in df.select("id", expr).collect()}


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


def test_phrases(phrases):
    rows = {r["id"]: r for r in enrich(phrases, "t").collect()}
    for i, (label, types, masked) in EXPECTED.items():
        assert rows[i]["sentimento"] == label, i
        assert rows[i]["tipos_pii_detectados"] == types, i
        assert rows[i]["tem_pii"] == bool(types), i
        assert rows[i]["texto_anonimizado"] == (masked or PHRASES[i]), i


def test_single_functions_agree_with_enrich(phrases):
    t = F.col("t")
    labels = values(phrases, txt.sentiment_label(t))
    types = values(phrases, txt.pii_types(t))
    masked = values(phrases, txt.anonymize(t))
    for i, (label, kinds, text) in EXPECTED.items():
        assert (labels[i], types[i], masked[i]) == (label, kinds, text or PHRASES[i])


def test_sql_functions(spark, phrases):
    register_functions(spark)
    rows = spark.sql("SELECT id, sentimento_ptbr(t) AS s, anonimizar(t) AS a FROM {p}", p=phrases)
    for r in rows.collect():
        assert r["s"] == EXPECTED[r["id"]][0]
        assert r["a"] == (EXPECTED[r["id"]][2] or PHRASES[r["id"]])


def test_token_mode_wants_whole_words(phrases):
    labels = values(phrases, txt.sentiment_label(F.col("t"), mode="token"))
    assert labels[22] == "neutro"      # "bombeiro" is not "bom"
    assert labels[2] == "negativo"     # the longer "não recomendo" wins
    assert labels[3] == "negativo"     # "insatisfeito" is not "satisfeito"


def test_sentiment_score(spark):
    score = lambda t: one(spark, t, txt.sentiment_score)
    assert tuple(score("ok")) == ("NEUTRO", 0.5)
    assert tuple(score(" \t\n ")) == ("NEUTRO", 0.5)
    assert tuple(score(None)) == ("NEUTRO", 0.5)
    assert tuple(score("Bom")) == ("POSITIVO", 0.6)
    assert tuple(score("excelente ótimo bom perfeito feliz gostei adorei")) == ("POSITIVO", 0.9)
    assert tuple(score("péssimo e horrível")) == ("NEGATIVO", 0.7)


def test_risk(phrases):
    risk = values(phrases, txt.reputational_risk(F.col("t")))
    assert tuple(risk[1]) == ("MEDIO", "TEMPO", 1.0)
    assert tuple(risk[17]) == ("ALTO", "SEGURANCA", 3.0)
    assert tuple(risk[18]) == ("MEDIO", "FINANCEIRO", 1.8)
    assert tuple(risk[19]) == ("BAIXO", "SISTEMA", 0.6)
    assert all(tuple(risk[i]) == ("NENHUM", "NENHUMA", 0.0)
               for i in range(24) if i not in (1, 17, 18, 19))


def test_risk_ladder_has_no_float_edges(spark):
    text = "mal atendido, sistema fora, travou"  # 0.8 + 0.6 + 0.6
    assert tuple(one(spark, text, txt.reputational_risk)) == ("ALTO", "ATENDIMENTO,SISTEMA", 2.0)


def test_critical_patterns(phrases, spark):
    found = values(phrases, txt.critical_patterns(F.col("t")))
    assert found[20] == ["AMEACA"]
    assert one(spark, "RACISMO! O dinheiro SUMIU", txt.critical_patterns) == [
        "DISCRIMINACAO", "PROBLEMA_GRAVE"]
    assert one(spark, "AÇÃO JUDICIAL", txt.critical_patterns) == ["AMEACA"]


def test_mask_and_types_text(spark):
    assert one(spark, "CEP 01310-100, ana@x.com, (11) 98888-7777", txt.mask_pii) == (
        "CEP [CEP_MASCARADO], [EMAIL_MASCARADO], [TELEFONE_MASCARADO]")
    assert one(spark, "CPF 123.456.789-00", txt.mask_pii) == "CPF [CPF_MASCARADO]"
    assert one(spark, "nada", txt.pii_types_str) == "NENHUM"
    assert one(spark, "a@b.com 12345678900", txt.pii_types_str) == "CPF,EMAIL,TELEFONE"


def test_author_functions(spark):
    assert one(spark, "joão", txt.anonymize_author).startswith("J***")
    assert one(spark, "  ", txt.anonymize_author) == "Anônimo"
    assert one(spark, None, txt.anonymize_author) == "Anônimo"
    pseudo = lambda c: txt.pseudonymize(c, "s")
    assert one(spark, " Ana ", pseudo) == one(spark, "ANA", pseudo)
    assert re.fullmatch(r"AUTOR_[0-9A-F]{8}", one(spark, "Ana", pseudo))
    assert one(spark, "", pseudo) == one(spark, None, pseudo) == "ANONIMO"


def test_clean_text(spark):
    text = "Olá!!  veja https://x.com/a?b=1 ou #ana@x.com\n\tfim "
    assert one(spark, text, txt.clean_text) == "Olá!! veja https: x.com a?b 1 ou ana x.com fim"
    useful = lambda c: txt.clean_text(c, faithful=False)
    assert one(spark, text, useful) == "Olá!! veja ou EMAIL fim"
    assert one(spark, None, txt.clean_text) == ""


@pytest.mark.parametrize("name", rules.BAIRROS)
def test_title_case_restores_slugs(name):
    # What Python's own title() gives is what unslug must give.
    assert name.lower().replace(" ", "_").replace("_", " ").title() in (name, name.title())


def test_unslug(spark):
    df = spark.createDataFrame([(b,) for b in rules.BAIRROS], "b string")
    for r in df.select("b", txt.unslug(txt.slug(F.col("b"))).alias("u")).collect():
        assert r["u"] == r["b"].lower().title()


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet="ab@. 0123456789()-ção", max_size=60), min_size=1, max_size=30))
def test_anonymised_text_equals_python_rules(spark, texts):
    """Against the rules restated with Python's re, on arbitrary text."""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in enrich(df, "t").collect():
        text, masked, kinds = texts[r["id"]], texts[r["id"]], []
        for kind, pattern, token in rules.PII_RULES:
            if re.search(pattern, text):
                kinds.append(kind)
                masked = re.sub(pattern, token, masked)
        assert r["tipos_pii_detectados"] == kinds
        assert r["texto_anonimizado"] == masked
        if kinds:
            assert not re.search(rules.EMAIL_PATTERN, r["texto_anonimizado"])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(st.sampled_from(
    rules.POSITIVE_TERMS + rules.NEGATIVE_TERMS + ("", "X", "ÓTIMO", "in", "des")), max_size=8)
    .map("".join), min_size=1, max_size=20))
def test_sentiment_equals_python_rules(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("id", txt.sentiment_label(F.col("t")).alias("s")).collect():
        low = texts[r["id"]].lower()
        pos = sum(w in low for w in rules.POSITIVE_TERMS)
        neg = sum(w in low for w in rules.NEGATIVE_TERMS)
        assert r["s"] == ("positivo" if pos > neg else "negativo" if neg > pos else "neutro")


def test_terms_are_tested_by_shared_pieces(spark):
    for terms in (rules.POSITIVE_TERMS, rules.NEGATIVE_TERMS):
        groups = txt.by_piece(terms)
        assert sorted(t for _, some in groups for t in some) == sorted(terms)
        assert all(piece in t for piece, some in groups for t in some)
        # Texts without a term mostly cost one test per group.
        assert len(groups) <= 2 * len(terms) / 3
        texts = [None, "", *terms, *[piece for piece, _ in groups], " ".join(terms), *[t[1:] + t[:1] for t in terms]]
        rows = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r["t"]: r["n"] for r in rows.select("t", txt.count_terms(F.col("t"), terms).alias("n")).collect()}
        assert got == {t: sum(term in t for term in terms) if t else 0 for t in texts}
