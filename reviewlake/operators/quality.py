"""Data quality: scores, checks, reports and gates over branches and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import rules
from reviewlake.functions.dates import to_date_or_null, to_timestamp_or_null
from reviewlake.functions.numeric import clamp01, mean_exact, percent, ratio
from reviewlake.sources.landing import branch_points

ISSUE_TYPE = "array<struct<tipo: string, severidade: string, problema: string>>"


#: Bits of the bitmap of suspect fingerprints: 4 MB.
BITMAP_BITS = 25

# --- collection completeness -------------------------------------------------

def completeness(branches: DataFrame, by: str = "bairro") -> DataFrame:
    """Completeness per group: points earned over points possible (6 per branch)."""
    return branches.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_agencias"),
        F.sum(F.coalesce(F.size("reviews"), F.lit(0))).alias("total_reviews"),
        F.sum(branch_points()).alias("_points"),
    ).withColumn(
        "completeness_score", ratio(F.col("_points"), F.col("total_agencias") * 6)
    ).drop("_points")


# --- branch checks -----------------------------------------------------------

def _present(name: str) -> Column:
    """Truthiness of a required field: not NULL, not empty."""
    column = F.col(name)
    if name == "geometry":
        filled = F.col("geometry.location").isNotNull()
    elif name == "types":
        filled = F.size(column) > 0
    else:
        filled = column != ""
    return F.coalesce(filled, F.lit(False))


def has_rating() -> Column:
    return F.coalesce(F.col("rating") != 0, F.lit(False))


def rating_invalid(criteria: dict = rules.CRITERIA) -> Column:
    rating = F.col("rating")
    return has_rating() & ((rating < criteria["rating_min"]) | (rating > criteria["rating_max"]))


def without_coordinates() -> Column:
    """A coordinate that is missing or exactly 0 counts as not set."""
    def zero(c):
        return F.coalesce(F.col(c) == 0, F.lit(True))

    return zero("geometry.location.lat") | zero("geometry.location.lng")


def branch_problems(criteria: dict = rules.CRITERIA, position: str = "list_pos") -> Column:
    """array<struct<tipo, severidade, problema>> of everything wrong with one branch."""
    where = F.concat(F.lit("Agência "), (F.col(position) + 1).cast("string"))

    def issue(kind, message):
        return F.struct(F.lit(kind).alias("tipo"), F.lit("critico").alias("severidade"),
                        message.alias("problema"))

    checks = [
        F.when(~_present(name), issue(
            f"campo_ausente:{name}", F.concat(where, F.lit(f": campo '{name}' ausente ou vazio"))))
        for name in criteria["required"]
    ]
    checks.append(F.when(rating_invalid(criteria), issue(
        "rating_invalido",
        F.concat(where, F.lit(": rating inválido ("), F.col("rating").cast("string"), F.lit(")")))))
    return F.array_compact(F.array(*checks)).cast(ISSUE_TYPE)


def _missing_fields(criteria: dict) -> Column:
    total = F.lit(0)
    for name in criteria["required"]:
        total = total + (~_present(name)).cast("int")
    return total


# --- neighbourhood validation ------------------------------------------------

def validate_bairros(branches: DataFrame, criteria: dict = rules.CRITERIA, by: str = "bairro",
                     expected: DataFrame | None = None, extended: bool = False) -> DataFrame:
    """One row per neighbourhood: metrics, score, approval and recommendations.

    Problems are counted here and listed, one row each, by ``problem_rows``: the
    list of a large neighbourhood has no bound. ``expected`` names neighbourhoods
    that must appear even when no branch was found for them.
    """
    metrics = branches.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_agencias"),
        F.sum(F.coalesce(F.size("reviews"), F.lit(0))).alias("total_reviews"),
        F.count_if(has_rating()).alias("agencias_com_rating"),
        F.count_if(without_coordinates()).alias("agencias_sem_coordenadas"),
        F.sum(_missing_fields(criteria)).alias("campos_ausentes"),
        F.count_if(rating_invalid(criteria)).alias("ratings_invalidos"),
    )
    if expected is not None:
        zeros = [c for c in metrics.columns if c != by]
        metrics = expected.select(by).distinct().join(metrics, by, "left").fillna(0, zeros)
    n = F.col("total_agencias")
    metrics = metrics.withColumns({
        "percentual_com_rating": F.coalesce(
            ratio(F.col("agencias_com_rating"), n) * 100, F.lit(0.0)),
        "problemas_criticos": F.col("campos_ausentes") + F.col("ratings_invalidos"),
        "problemas_menores": (n < criteria["min_agencias"]).cast("bigint")
        + (n > criteria["max_agencias"]).cast("bigint"),
    }).withColumn("score_qualidade", quality_score())
    return metrics.withColumns({
        "recomendacoes": recommendations(criteria, extended),
        "aprovado": F.col("score_qualidade") >= criteria["min_score"],
    })


def quality_score() -> Column:
    uncovered = F.coalesce(
        ratio(F.col("agencias_sem_coordenadas"), F.col("total_agencias")), F.lit(0.0))
    base = (
        F.lit(1.0) - F.col("problemas_criticos") * F.lit(0.15)
        - F.col("problemas_menores") * F.lit(0.05)
        + F.col("percentual_com_rating") / 100 * F.lit(0.2)
    )
    return clamp01(F.when(uncovered > 0.1, base - uncovered * F.lit(0.3)).otherwise(base))


def recommendations(criteria: dict = rules.CRITERIA, extended: bool = False) -> Column:
    """array<string> of advice; the extended variant has finer steps and a fallback."""
    n, without = F.col("total_agencias"), F.col("agencias_sem_coordenadas")
    rated = F.col("percentual_com_rating")
    if not extended:
        return F.array_compact(F.array(
            F.when(rated < 50, F.lit("Poucas agências com rating - verificar filtros de busca")),
            F.when(without > n * 0.1,
                   F.lit("Muitas agências sem coordenadas - verificar geocoding")),
        ))
    advice = F.array_compact(F.array(
        F.when(rated < 30, F.lit(
            "Muito poucas agências com rating - verificar filtros de busca e tipos"))
        .when(rated < 50, F.lit(
            "Poucas agências com rating - considerar ajustar query de busca")),
        F.when((n > 0) & (without / n > 0.1), F.lit(
            "Muitas agências sem coordenadas - verificar processo de geocoding")),
        F.when(n == 0, F.lit("Nenhuma agência encontrada - revisar query de busca e filtros"))
        .when(n > criteria["max_agencias"], F.lit(
            "Muitas agências encontradas - refinar filtros para evitar resultados irrelevantes")),
        F.when(F.col("campos_ausentes") > 0, F.lit(
            "Campos obrigatórios ausentes - verificar mapeamento da API")),
        F.when(F.col("ratings_invalidos") > 0, F.lit(
            "Ratings inválidos detectados - verificar validação de dados")),
    ))
    fallback = F.array(F.lit("Revisar processo de coleta para melhorar qualidade dos dados"))
    return F.when((F.size(advice) == 0) & (F.col("score_qualidade") < 0.8), fallback).otherwise(advice)


def failed_documents(broken: DataFrame, validated: DataFrame, by: str = "bairro",
                     folder: str = "part_bairro") -> DataFrame:
    """Validation rows of documents that could not be read: score 0, not approved, nothing counted.

    ``broken`` comes from ``unreadable``; append the result to ``validated`` before the day's report.
    """
    fixed = {by: F.col(folder) if folder in broken.columns else F.lit(None),
             "score_qualidade": F.lit(0.0), "aprovado": F.lit(False),
             "recomendacoes": F.array(F.lit("Documento ilegível - coletar novamente"))}
    return broken.select(*[
        fixed.get(f.name, F.lit(0)).cast(f.dataType).alias(f.name) for f in validated.schema.fields])


def problem_rows(branches: DataFrame, validated: DataFrame, criteria: dict = rules.CRITERIA,
                 by: str = "bairro") -> DataFrame:
    """Every problem as a row: those of branches and those of whole neighbourhoods."""
    branch = branches.select(
        by, "list_pos", F.inline(branch_problems(criteria))
    ).select(by, (F.col("list_pos") + 1).alias("posicao"), "tipo", "severidade", "problema")
    n = F.col("total_agencias")
    few = f"Menos de {criteria['min_agencias']} agências encontradas"
    many = F.concat(F.lit("Muitas agências encontradas ("), n.cast("string"),
                    F.lit("), verificar filtros"))
    whole = validated.filter(F.col("problemas_menores") > 0).select(
        by, F.lit(0).alias("posicao"),
        F.when(n < criteria["min_agencias"], F.lit("poucas_agencias"))
        .otherwise(F.lit("muitas_agencias")).alias("tipo"),
        F.lit("menor").alias("severidade"),
        F.when(n < criteria["min_agencias"], F.lit(few)).otherwise(many).alias("problema"),
    )
    return branch.unionByName(whole)


# --- day report --------------------------------------------------------------

def integrity_report(validated: DataFrame, as_of: str) -> DataFrame:
    """One row for the day: totals, means and overall status."""
    report = validated.agg(
        F.count(F.lit(1)).alias("total_bairros"),
        F.count_if("aprovado").alias("bairros_validos"),
        F.count_if(~F.col("aprovado")).alias("bairros_com_problemas"),
        F.coalesce(F.sum("total_agencias"), F.lit(0).cast("bigint")).alias("total_agencias"),
        F.coalesce(F.sum("total_reviews"), F.lit(0).cast("bigint")).alias("total_reviews"),
        F.coalesce(mean_exact(F.col("score_qualidade"), 12), F.lit(0.0)).alias("score_medio_qualidade"),
    )
    share = ratio(F.col("bairros_validos"), F.col("total_bairros"))
    return report.withColumns({
        "percentual_bairros_validos": share,
        "media_agencias_por_bairro": ratio(F.col("total_agencias"), F.col("total_bairros")),
        "status": F.when(F.col("total_bairros") == 0, F.lit("sem_dados"))
        .when(share >= 0.9, F.lit("excelente")).when(share >= 0.7, F.lit("bom"))
        .when(share >= 0.5, F.lit("aceitavel")).otherwise(F.lit("problematico")),
        "data": F.lit(as_of[:10]),
    })


def report_lines(report: DataFrame, validated: DataFrame, problems: DataFrame,
                 by: str = "bairro") -> DataFrame:
    """The report as rows of text; sort by ``secao, chave, item`` to read it."""
    def line(fmt, *columns):
        return F.format_string(fmt, *columns)

    share = F.coalesce(F.col("percentual_bairros_validos") * 100, F.lit(0.0))
    head = [
        line("=== RELATÓRIO DE QUALIDADE - %s ===", F.col("data")),
        line("Status Geral: %s", F.upper("status")),
    ]
    body = [
        F.lit("MÉTRICAS GERAIS:"),
        line("  • Total de bairros: %d", F.col("total_bairros")),
        line("  • Bairros válidos: %d (%.1f%%)", F.col("bairros_validos"), share),
        line("  • Bairros com problemas: %d", F.col("bairros_com_problemas")),
        line("  • Total de agências: %d", F.col("total_agencias")),
        line("  • Média de agências por bairro: %.1f",
             F.coalesce(F.col("media_agencias_por_bairro"), F.lit(0.0))),
        line("  • Total de reviews: %d", F.col("total_reviews")),
        line("  • Score médio de qualidade: %.2f", F.col("score_medio_qualidade")),
    ]
    empty = [
        F.lit("STATUS: Nenhum dado encontrado para esta data"),
        line("Mensagem: Nenhum dado encontrado para %s", F.col("data")),
    ]
    lines = F.when(F.col("status") == "sem_dados", F.array(*head, *empty)).otherwise(
        F.array(*head, *body))
    top = report.select(F.posexplode(lines).alias("item", "linha")).select(
        F.lit(0).alias("secao"), F.lit("").alias("chave"), "item", "linha"
    )
    failed = validated.filter(~F.col("aprovado"))
    names = failed.select(
        F.lit(1).alias("secao"), F.col(by).alias("chave"), F.lit(-1).alias("item"),
        line("  %s (Score: %.2f)", F.col(by), F.col("score_qualidade")).alias("linha"),
    )
    details = problems.join(failed.select(by), by, "left_semi").select(
        F.lit(1).alias("secao"), F.col(by).alias("chave"), F.col("posicao").alias("item"),
        F.concat(F.lit("     - "), "problema").alias("linha"),
    )
    return top.unionByName(names).unionByName(details)


def gate_refusals(validated: DataFrame, min_score: float = 0.7, score: str = "score_qualidade") -> DataFrame:
    """The rows at which ``quality_gate`` would fail the job."""
    return validated.filter(~F.coalesce(F.col(score) >= min_score, F.lit(False)))


def quality_gate(validated: DataFrame, min_score: float = 0.7,
                 score: str = "score_qualidade") -> DataFrame:
    """Pass the rows through, failing the job at the first score below the limit.

    The check is a filter, which no column pruning can drop.
    """
    message = F.concat(
        F.lit("Qualidade dos dados abaixo do limite: "),
        F.coalesce(F.col(score).cast("string"), F.lit("sem score")))
    good = F.coalesce(F.col(score) >= min_score, F.lit(False))
    return validated.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


# --- review checks -----------------------------------------------------------

def validate_nlp(silver: DataFrame) -> DataFrame:
    label = F.col("sentimento")
    checks = silver.agg(
        F.count_if(label.isNull()).alias("sentimento_nulo"),
        F.count_if(~label.isin(*rules.SENTIMENTS)).alias("sentimento_invalido"),
        F.count_if(F.col("tem_pii").isNull()).alias("tem_pii_nulo"),
    )

    def message(level, column, what):
        n = F.col(column)
        return F.when(n > 0, F.concat(F.lit(f"{level}: "), n.cast("string"), F.lit(f" {what}")))

    return checks.withColumn("mensagens", F.array_compact(F.array(
        message("ERRO", "sentimento_nulo", "registros com sentimento nulo"),
        message("ERRO", "sentimento_invalido", "sentimentos inválidos"),
        message("AVISO", "tem_pii_nulo", "registros com tem_pii nulo"),
    )))


def _violations(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One pass over the data for all rules, one output row per rule."""
    counters = [F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counters)
    entries = F.array(*[
        F.struct(F.lit(column).alias("coluna"), F.lit(rule).alias("regra"),
                 F.col(f"_{i}").alias("violacoes"))
        for i, (column, rule, _) in enumerate(checks)
    ])
    return totals.select("total", F.inline(entries)).select(
        "coluna", "regra", "violacoes", "total",
        (F.lit(100.0) - F.coalesce(percent(F.col("violacoes"), F.col("total")), F.lit(0.0)))
        .alias("percentual_ok"),
    )


def range_violations(df: DataFrame, limits=rules.RANGE_RULES) -> DataFrame:
    """Values outside their range; NULL is the business of ``null_violations``."""
    checks = []
    for column, low, high in limits:
        if column not in df.columns:
            continue
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(column) < low)
        if high is not None:
            bad = bad | (F.col(column) > high)
        checks.append((column, "range", F.coalesce(bad, F.lit(False))))
    return _violations(df, checks)


def format_violations(df: DataFrame, patterns=rules.FORMAT_RULES,
                      dates=rules.DATE_COLUMNS) -> DataFrame:
    checks = [
        (c, "formato", F.coalesce(~F.col(c).rlike(p), F.lit(False))) for c, p in patterns
    ]
    for c in dates:
        shape = F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$") & to_date_or_null(F.col(c)).isNotNull()
        checks.append((c, "data", F.coalesce(~shape, F.lit(False))))
    return _violations(df, checks)


def null_violations(df: DataFrame, required=rules.REQUIRED_COLUMNS) -> DataFrame:
    return _violations(df, [(c, "obrigatorio", F.col(c).isNull()) for c in required])


def length_violations(df: DataFrame, limits=rules.LENGTH_RULES) -> DataFrame:
    return _violations(df, [
        (c, "tamanho", F.coalesce(~F.length(c).between(low, high), F.lit(False)))
        for c, low, high in limits
    ])


def duplicates(df: DataFrame, keys) -> DataFrame:
    """The keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("ocorrencias")).filter("ocorrencias > 1")


def uniqueness(df: DataFrame, keys) -> DataFrame:
    n = F.col("_n")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias("total"),
        F.count(F.lit(1)).alias("chaves_distintas"),
        F.count_if(n > 1).alias("chaves_repetidas"),
        F.coalesce(F.sum(n - 1), F.lit(0).cast("bigint")).alias("linhas_excedentes"),
    ).withColumn("percentual_unico", percent(F.col("chaves_distintas"), F.col("total")))


def _suspects(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """``(flags, rows)``: how often each fingerprint of the keys occurs, and the rows that may repeat a key.

    Only eight bytes a row are shuffled for the counts. Fingerprints that occur more
    than once set a bit each in a bitmap of ``1 << BITMAP_BITS`` bits, at most 4 KB a
    row in ``1 << (BITMAP_BITS - 15)`` rows, which goes to every task; rows whose
    bit is not set cannot repeat a key. A bit set by chance only lets a row through.
    """
    fingerprint = F.xxhash64(*keys)
    counted = df.select(fingerprint.alias("_fp")).groupBy("_fp").agg(F.count(F.lit(1)).alias("_n"))
    place = F.shiftrightunsigned("_fp", 64 - BITMAP_BITS)
    bitmap = counted.filter("_n > 1").select(place.alias("_p")).groupBy(
        F.bitmap_bucket_number(F.col("_p") + 1).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_p") + 1)).alias("_bits"))

    def flagged(rows: DataFrame) -> DataFrame:
        placed = rows.withColumn("_p", place)
        joined = placed.join(F.broadcast(bitmap), F.bitmap_bucket_number(F.col("_p") + 1) == F.col("_bucket"), "left")
        bit = F.bitmap_bit_position(F.col("_p") + 1).cast("int")
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.expr("coalesce(shiftright(_byte, _bit) & 1, 0) = 1")
        return joined.withColumns({"_byte": byte, "_bit": bit.bitwiseAND(7)}).withColumn("_hit", hit)

    rows = flagged(df.select(*keys, fingerprint.alias("_fp"))).filter("_hit").select(*keys)
    return flagged(counted), rows


def duplicates_by_suspects(df: DataFrame, keys) -> DataFrame:
    """``duplicates``, shuffling only the keys of rows that may repeat one."""
    return duplicates(_suspects(df, keys)[1], keys)


def uniqueness_by_suspects(df: DataFrame, keys) -> DataFrame:
    """``uniqueness``, shuffling fingerprints of all rows but only the keys of rows that may repeat one.

    It reads its input twice: for stored layers with long keys, not for costly views.
    """
    flags, rows = _suspects(df, keys)
    alone = flags.filter("not _hit").agg(F.count(F.lit(1)).alias("_alone"))
    repeated = uniqueness(rows, keys).drop("percentual_unico")
    whole = repeated.join(alone).select(
        (F.col("total") + F.col("_alone")).alias("total"),
        (F.col("chaves_distintas") + F.col("_alone")).alias("chaves_distintas"),
        "chaves_repetidas", "linhas_excedentes")
    return whole.withColumn("percentual_unico", percent(F.col("chaves_distintas"), F.col("total")))


def temporal_violations(df: DataFrame) -> DataFrame:
    """review_time <= data_coleta <= ingestion <= processing, where the columns exist."""
    collected = to_timestamp_or_null(F.col("data_coleta"))
    checks = [
        ("review_time", "ordem_temporal",
         F.timestamp_seconds("review_time") > collected),
        ("bronze_ingestion_date", "ordem_temporal",
         F.col("bronze_ingestion_date").cast("timestamp") < collected),
    ]
    if "silver_processing_timestamp" in df.columns:
        checks.append((
            "silver_processing_timestamp", "ordem_temporal",
            F.col("silver_processing_timestamp") < F.col("bronze_ingestion_timestamp")))
    return _violations(df, [(c, r, F.coalesce(b, F.lit(False))) for c, r, b in checks])


def evaluate_thresholds(metrics: DataFrame, thresholds=rules.THRESHOLDS) -> DataFrame:
    """metrics(metrica, percentual) against the limits; an action where one is violated."""
    limits = F.create_map(*[
        c for metric, low, inclusive, action in thresholds for c in (F.lit(metric), F.struct(
            F.lit(low).alias("minimo"), F.lit(inclusive).alias("inclui"), F.lit(action).alias("acao")))
    ])
    known = metrics.withColumn("_l", F.try_element_at(limits, F.col("metrica"))).filter(
        F.col("_l").isNotNull())
    value, low = F.col("percentual"), F.col("_l.minimo")
    passed = F.when(F.col("_l.inclui"), value >= low).otherwise(value > low)
    return known.select(
        "metrica", "percentual", low.alias("minimo"), passed.alias("aprovado"),
        F.when(passed, F.lit("nenhuma")).otherwise(F.col("_l.acao")).alias("acao"),
    )


def schema_diff(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared against actual columns. Reads metadata only."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    actual = dict(df.dtypes)

    def verdict(name):
        if name not in actual:
            return "ausente"
        if name not in declared:
            return "inesperada"
        return "ok" if declared[name] == actual[name] else "tipo_diferente"

    rows = [
        (name, declared.get(name), actual.get(name), verdict(name))
        for name in [*declared, *(c for c in actual if c not in declared)]
    ]
    return df.sparkSession.createDataFrame(
        rows, "coluna string, esperado string, encontrado string, situacao string")


# --- across layers -----------------------------------------------------------

def orphans(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Both sides are reduced to one row per key first, so a hot key is one row in the join.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))
    return counted.join(parent.select(*keys).distinct(), list(keys), "left_anti")
