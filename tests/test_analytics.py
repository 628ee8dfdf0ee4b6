"""Operators that must not depend on skew, order or partitioning."""

import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from reviewlake.operators import analytics as an
from reviewlake.functions import text as txt
from reviewlake.operators import gold
from reviewlake.operators import quality as q
from reviewlake.queries import fixtures as fx
from conftest import SF_DIR


def test_nav_functions_against_brute_force(spark):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 5}", i, rng.choice([None, None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(7)
    for ignore in (True, False):
        got = {(r["k"], r["t"]): r for r in an.nav_functions(
            df, ["k"], ["t"], "v", ignore, bucket_rows=20).collect()}
        assert len(got) == 300
        for k in {r[0] for r in rows}:
            series = sorted((t, v) for key, t, v in rows if key == k)
            kept = [v for _, v in series if v is not None or not ignore]
            for i, (t, _) in enumerate(series):
                before = [v for _, v in series[:i] if v is not None or not ignore]
                after = [v for _, v in series[i + 1:] if v is not None or not ignore]
                r = got[k, t]
                assert r["lag_value"] == (before[-1] if before else None)
                assert r["lead_value"] == (after[0] if after else None)
                assert r["first_value"] == (kept[0] if kept else None)
                assert r["last_value"] == (kept[-1] if kept else None)
                assert r["nth_value"] == (kept[1] if len(kept) > 1 else None)


def test_nav_functions_have_no_shrinking_frame(spark):
    df = spark.createDataFrame([("a", i, i) for i in range(50)], "k string, t int, v int")
    plan = an.nav_functions(df, ["k"], ["t"], "v")._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedpreceding$(), -1" in plan
    assert "1, unboundedfollowing" not in plan


def test_sentinel_only_when_calm(spark):
    silver = fx.silver(spark, SF_DIR)
    assert gold.risk_alerts(silver, fx.AS_OF).filter("place_id = 'sem_alertas'").count() == 0
    calm = gold.risk_alerts(silver.filter("sentimento = 'positivo'"), fx.AS_OF).collect()
    assert [(r["place_id"], r["total_reviews_negativas"]) for r in calm] == [("sem_alertas", 0)]


def test_alerts_are_computed_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        alerts = gold.risk_alerts(fx.silver(spark, SF_DIR), fx.AS_OF)
        assert "ReusedExchange" in alerts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_filters_limit_before_the_shuffle(spark):
    rows = fx.table(spark, SF_DIR, "conversations")
    text = plan(an.dedup_first(rows, "conv_id", ["turn", "text"]))
    assert text.count("WindowGroupLimit") >= 2


def test_no_plan_uses_python_or_a_cross_join(spark):
    import __spark_entry__ as entrypoint
    from bench import HEADLINES

    for name in (*HEADLINES, "risk_alerts_sentinel", "rank_agencies", "progress_stats",
                 "mark_consulted", "next_bairro", "evaluate_thresholds", "report_lines"):
        text = plan(entrypoint.queries()[name](spark, SF_DIR))
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                    "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)


def test_shuffle_settings_follow_the_data():
    from reviewlake.session import shuffle_settings

    assert shuffle_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert shuffle_settings(10 << 40)["spark.sql.shuffle.partitions"] == "40960"


def test_scans_read_only_what_is_needed(spark):
    silver = fx.silver(spark, SF_DIR)
    text = plan(an.run_stats(fx.bronze(spark, SF_DIR)))
    assert not any(c in text for c in ("l_quantity", "o_totalprice", "c_name"))
    assert "l_quantity" not in plan(an.sentiment_counts(silver))


def test_totals_agree(spark):
    silver = fx.silver(spark, SF_DIR).cache()
    kpis = gold.agency_performance_kpis(silver, fx.AS_OF)
    sums = kpis.agg(F.sum("total_reviews"), F.sum("reviews_positivos"), F.sum("reviews_negativos"),
                    F.sum("reviews_neutros")).first()
    assert sums[0] == sums[1] + sums[2] + sums[3] == silver.count()
    board = gold.executive_dashboard(silver, fx.AS_OF).first()
    assert (board["total_reviews"], board["reviews_positivos"], board["reviews_negativos"]) == sums[:3]


def test_results_do_not_depend_on_partitioning(spark):
    silver = fx.silver(spark, SF_DIR).cache()
    one, many = silver.coalesce(1), silver.repartition(13)
    for build in (an.bairro_kpis, an.rating_sentiment_corr, an.monthly_trend):
        assert sorted(map(str, build(one).collect())) == sorted(map(str, build(many).collect()))


def test_approximate_run_stats(spark):
    exact = an.run_stats(fx.bronze(spark, SF_DIR)).first()
    rough = an.run_stats(fx.bronze(spark, SF_DIR), approx=True).first()
    assert exact["total_reviews"] == rough["total_reviews"]
    assert abs(exact["agencias_unicas"] - rough["agencias_unicas"]) <= max(1, exact["agencias_unicas"] // 10)


def test_empty_silver(spark):
    empty = fx.silver(spark, SF_DIR).filter("place_id IS NULL")
    assert gold.executive_dashboard(empty, fx.AS_OF).first()["total_agencias"] == 0
    assert an.nlp_metrics(empty).first()["total_processados"] == 0
    assert an.rating_sentiment_corr(empty).first()["correlacao"] is None


def test_orphan_parents_are_reduced_before_the_join(spark):
    bronze, silver = fx.bronze(spark, SF_DIR), fx.silver(spark, SF_DIR)
    text = plan(q.orphans(silver, bronze, ["place_id"]))
    # Both sides of the join come from an aggregate: partial before the shuffle, final after it.
    assert text.count("HashAggregate(keys=[place_id") == 4


def test_sentiment_is_generated_code(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("t"))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.select(txt.sentiment_label(F.col("t"))).explain("codegen")
    assert "project_" in out.getvalue() and "lambda" not in out.getvalue()


def test_methods_of_silver_are_small_enough_to_compile(spark):
    def largest(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("codegen")
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+);", out.getvalue())))

    # The JVM leaves methods of more than 8,000 bytes uncompiled.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        silver = fx.silver(spark, SF_DIR)
        assert largest(silver) < 6000
        assert largest(gold.agency_performance_kpis(silver, fx.AS_OF)) < 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_no_label_is_computed_in_a_filter(spark):
    from reviewlake import queries as registry

    registry.load_all()
    for name in ("sentiment_equality", "risk_alerts_sentinel"):
        plan = registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
        assert filters and not any("Contains" in line or "contains(" in line for line in filters), name


def test_known_rows_put_no_label_into_a_filter(spark):
    columns = ["nome_agencia", "bairro", "rating_review", "sentimento", "tem_pii"]
    rows = fx.silver(spark, SF_DIR).select(*columns)
    few = spark.createDataFrame(rows.limit(2).collect() + [("nobody", "x", 1, "neutro", False)], rows.schema)
    known = an.known_rows(few, rows)
    assert sorted(str(r["_known"]) for r in known.collect()) == ["1", "1", "None"]
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("Contains(" in line for line in filters)
