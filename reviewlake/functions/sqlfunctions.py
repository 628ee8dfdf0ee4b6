"""The text functions under names SQL can call.

They are SQL functions: a query that calls one is planned as if it had spelled
the expression out, so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from reviewlake.functions import rules


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hits(terms) -> str:
    return " + ".join(f"CAST(contains(lower(texto), {_quoted(t)}) AS INT)" for t in terms)


def register_functions(spark: SparkSession) -> None:
    """``sentimento_ptbr(texto)`` and ``anonimizar(texto)`` as temporary functions."""
    balance = (f"coalesce(({_hits(rules.POSITIVE_TERMS)}) - ({_hits(rules.NEGATIVE_TERMS)}), 0)")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sentimento_ptbr(texto STRING) RETURNS STRING "
        f"RETURN elt(CAST(signum({balance}) AS INT) + 2, 'negativo', 'neutro', 'positivo')")
    result = "texto"
    for _, pattern, token in rules.PII_RULES:
        quoted = _quoted("(?U)" + pattern)
        result = (f"CASE WHEN texto RLIKE {quoted} THEN regexp_replace({result}, {quoted}, '{token}') "
                  f"ELSE {result} END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION anonimizar(texto STRING) RETURNS STRING "
        f"RETURN {result}")
