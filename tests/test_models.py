import datetime

import numpy as np
import pandas as pd
import pytest

from crivo.operators import confidence, evaluate, models, report
from crivo.spec import FUNDS

DAY = datetime.date


def long_predictions(seed=3, dates=4, tickers=30):
    rng = np.random.default_rng(seed)
    rows, real = [], []
    for d in range(dates):
        for t in range(tickers):
            key = (DAY(2026, 1, 1 + d), "FII", f"T{t:02d}")
            ret = float(np.round(rng.normal(0, 0.05), 3))
            real.append((*key, ret if d < dates - 1 else None))
            rows.append((*key, "Score Top", float(np.round(rng.uniform(0, 100)))))
            rows.append((*key, "Ridge", float(ret + rng.normal(0, 0.05)) if t % 7 else None))
    return rows, real


def test_evaluation_matches_pandas(spark):
    rows, real = long_predictions()
    pred = spark.createDataFrame(rows, "Data_Execucao date, Tipo string, Ticker string, Modelo string, score double")
    done = spark.createDataFrame(real, "Data_Execucao date, Tipo string, Ticker string, y double")
    got = {r.Modelo: r for r in evaluate.evaluate(pred, done, "y", "7d", n=10).collect()}

    p = pd.DataFrame(rows, columns=["d", "c", "t", "m", "s"])
    y = pd.DataFrame(real, columns=["d", "c", "t", "y"]).dropna()
    both = p.dropna().merge(y, on=["d", "c", "t"])
    tops = {}
    for name, part in both.groupby("m"):
        hits, ics = [], []
        for d, group in part.groupby("d"):
            best = group.sort_values(["s", "t"], ascending=[False, True]).head(10)
            tops[(name, d)] = best["y"].mean()
            hits.append((best["y"] > 0).mean())
            ics.append(group["s"].rank().corr(group["y"].rank()))
        mine = [v for (m, _), v in tops.items() if m == name]
        assert got[name].Janelas_Validas == 3 and got[name].Status == "Ativo"
        assert got[name].Retorno_Medio_Top20 == pytest.approx(np.mean(mine))
        assert got[name].Hit_Rate_Top20 == pytest.approx(np.mean(hits))
        assert got[name].Spearman_IC == pytest.approx(np.mean(ics))
    alpha = np.mean([tops[("Ridge", d)] - tops[("Score Top", d)] for d in sorted(both["d"].unique())])
    assert got["Ridge"].Alpha_vs_Score_Top == pytest.approx(alpha)
    assert got["Score Top"].Alpha_vs_Score_Top == 0.0


def test_small_windows_and_constant_scores(spark):
    rows = [(DAY(2026, 1, 1), "FII", f"T{i}", "Ridge", 1.0) for i in range(6)] + [(DAY(2026, 1, 2), "FII", f"T{i}", "Ridge", 1.0 * i) for i in range(4)]
    real = [(d, c, t, 0.01 * i) for i, (d, c, t, _, _) in enumerate(rows)]
    pred = spark.createDataFrame(rows, "Data_Execucao date, Tipo string, Ticker string, Modelo string, score double")
    done = spark.createDataFrame(real, "Data_Execucao date, Tipo string, Ticker string, y double")
    table = evaluate.evaluate(pred, done, "y", "7d", classes=["FII", "ACAO"]).collect()
    measured = [r for r in table if r.Tipo == "FII"]
    assert len(measured) == 1 and measured[0].Janelas_Validas == 1 and measured[0].Spearman_IC is None
    idle = [r for r in table if r.Tipo == "ACAO"]
    assert len(idle) == 8 and {r.Status for r in idle} == {"Aquecendo"} and {r.Janelas_Validas for r in idle} == {0}


def perf(spark, *rows):
    return spark.createDataFrame(
        [(t, m, "30d", w, h, i, a) for t, m, w, h, i, a in rows],
        "Tipo string, Modelo string, Horizonte string, Janelas_Validas bigint, Hit_Rate_Top20 double, Spearman_IC double, Alpha_vs_Score_Top double",
    )


def dates(spark, *days):
    return spark.createDataFrame([(DAY.fromisoformat(d),) for d in days], "date date")


def test_no_confidence_without_windows(spark):
    table = confidence.with_confidence(perf(spark, ("ACAO", "Random Forest", 0, None, None, None)))
    assert table.first().Nivel_Confiabilidade == "Não mensurável"
    out = confidence.summary(table, dates(spark, "2026-06-21", "2026-07-08")).first()
    assert (out.status, out.confiabilidade_preditiva_pct, out.modelo_mais_confiavel) == ("Aquecendo", 0.0, None)
    assert out.maturidade_dados_pct == pytest.approx(56.67) and out.qtd_snapshots == 2
    assert out.mensagem.startswith("Aguardando pelo menos 1 janelas")


def test_confidence_with_windows(spark):
    table = confidence.with_confidence(
        perf(spark, ("ACAO", "Boosted Trees, depth 4", 8, 0.61, 0.18, 0.012), ("ACAO", "Score Top", 2, 0.4, None, 0.0), ("ACAO", "Ridge", 8, 0.61, 0.18, 0.012))
    )
    rows = {r.Modelo: r for r in table.collect()}
    # 40 for coverage, 25 * 0.11 / 0.15, 25 * 0.6, 10 * 0.4
    assert rows["Boosted Trees, depth 4"].Confiabilidade_Pct == pytest.approx(77.33) and rows["Boosted Trees, depth 4"].Nivel_Confiabilidade == "Alta"
    assert rows["Score Top"].Confiabilidade_Pct == pytest.approx(21.0)  # 40 * 0.4 + 10 * 0.5
    assert rows["Boosted Trees, depth 4"].Componentes_Confiabilidade.hit_rate == pytest.approx(73.33)
    out = confidence.summary(table, dates(spark, "2026-06-01", "2026-07-15")).first()
    assert out.status == "Ativo" and out.modelo_mais_confiavel.Modelo == "Ridge"  # equal: the earlier listed
    assert out.maturidade_dados_pct == 100.0 and out.nivel_confiabilidade == "Alta"
    assert [m.Modelo for m in out.por_modelo] == ["Boosted Trees, depth 4", "Ridge", "Score Top"]


def test_enriched_rows(spark):
    table = perf(spark, ("FII", "Score Top", 6, 0.55, 0.08, 0.0))
    row = confidence.enriched(table, confidence.with_confidence(table)).first()
    assert row.Confiabilidade_Pct > 0 and row.Nivel_Confiabilidade


def test_ensemble_and_leader(spark):
    d = DAY(2026, 1, 1)
    rows = [(d, "FII", "A", "Score Top", 99.0, None), (d, "FII", "A", "Ridge", 40.0, 0.1), (d, "FII", "A", "Random Forest", 40.0, 0.3), (d, "FII", "A", "Boosted Trees, depth 4", None, None), (d, "FII", "B", "Ridge", None, None)]
    df = spark.createDataFrame(rows, "Data_Execucao date, Tipo string, Ticker string, Modelo string, score double, predicted_return double")
    got = {r.Ticker: r for r in evaluate.ensemble(df).collect()}
    assert (got["A"].score_ensemble, got["A"].retorno_esperado, got["A"].modelo_lider) == (40.0, pytest.approx(0.2), "Ridge")
    assert (got["B"].score_ensemble, got["B"].modelo_lider) == (None, "Score Top")


def test_leaderboard_falls_back_to_the_baseline(spark):
    rows = [(DAY(2026, 1, 1), "FII", "OLD", 9.0, 1.0), (DAY(2026, 1, 2), "FII", "A", None, 1.0), (DAY(2026, 1, 2), "FII", "B", None, 2.0), (DAY(2026, 1, 2), "ACAO", "C", 5.0, 1.0), (DAY(2026, 1, 2), "ACAO", "D", None, 9.0)]
    df = spark.createDataFrame(rows, "Data_Execucao date, Tipo string, Ticker string, score_ensemble double, score_top double")
    got = {(r.Tipo, r.rank_modelo): r.Ticker for r in evaluate.leaderboard(df).collect()}
    assert got == {("FII", 1): "B", ("FII", 2): "A", ("ACAO", 1): "C", ("ACAO", 2): "D"}


def training_table(spark, n=120):
    rng = np.random.default_rng(5)
    table = pd.DataFrame({"FUNDOS": [f"T{i % 30:02d}" for i in range(n)], "Data_Execucao": [DAY(2026, 1, 1 + i // 30) for i in range(n)]})
    table["PREÇO ATUAL (R$)"] = rng.uniform(5, 10, n).round(2)
    table["NUM. COTISTAS"] = rng.integers(1, 1000, n).astype(float)
    table["Score"] = rng.uniform(0, 100, n).round(1)
    table.loc[::11, "Score"] = np.nan
    table["Retorno_Futuro_7d"] = 0.001 * table["NUM. COTISTAS"] + rng.normal(0, 0.01, n)
    table.loc[table["Data_Execucao"] == DAY(2026, 1, 4), "Retorno_Futuro_7d"] = np.nan
    return table, spark.createDataFrame(table)


FEATURES = ["PREÇO ATUAL (R$)", "NUM. COTISTAS", "Score"]


def test_ridge_equals_the_closed_form(spark):
    table, df = training_table(spark)
    found, note = models.training(df, FUNDS, "Retorno_Futuro_7d")
    assert found.features == FEATURES and note == "Modelos treinados com 90 linhas e 3 datas."
    got = models.ridge(found).toPandas().sort_values("id")["predicted_return"].to_numpy()

    known, today = table[table["Retorno_Futuro_7d"].notna()], table[table["Data_Execucao"] == DAY(2026, 1, 4)]
    medians = known[FEATURES].median()
    x, z = known[FEATURES].fillna(medians).to_numpy(), today.sort_values("FUNDOS")[FEATURES].fillna(medians).to_numpy()
    mean, spread, y = x.mean(0), x.std(0), known["Retorno_Futuro_7d"].to_numpy()
    x, z = (x - mean) / spread, (z - mean) / spread
    w = np.linalg.solve(x.T @ x + np.eye(3), x.T @ (y - y.mean()))
    np.testing.assert_allclose(got, z @ w + y.mean(), rtol=1e-9)


def test_shadow_run(spark):
    _, df = training_table(spark)
    out = models.shadow_run(df, FUNDS, 7, models.factories(trees=3, rounds=2))
    rows = out.collect()
    assert len(rows) == 30 and {r.status_modelos for r in rows} == {"Ativo"}
    assert all(r.score_ridge is not None and r.score_catboost is not None and r.retorno_esperado_7d is not None for r in rows)
    assert all(r.retorno_previsto_score_ridge_7d is not None for r in rows)
    assert {r.Data_Execucao for r in rows} == {DAY(2026, 1, 4)}
    long = models.long_form(out)
    assert long.select("Modelo").distinct().count() == 8


def test_shadow_run_waits_for_data(spark):
    _, df = training_table(spark, n=40)
    rows = models.shadow_run(df.drop("Retorno_Futuro_7d").withColumn("Retorno_Futuro_7d", df["Score"] * 0), FUNDS, 7, {}).collect()
    assert {r.status_modelos for r in rows} == {"Aquecendo"}
    few = models.shadow_run(df.limit(10), FUNDS, 7, {}).first()
    assert few.status_modelos == "Aquecendo" and few.motivo_status.startswith("Aguardando dados")


def test_a_failing_model_is_left_out(spark):
    _, df = training_table(spark)

    def broken(_):
        raise RuntimeError("no")

    rows = models.shadow_run(df, FUNDS, 7, {"score_ridge": models.ridge, "score_xgboost": broken}).collect()
    assert all(r.score_ridge is not None and r.score_xgboost is None and r.modelo_lider == "Ridge" for r in rows)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.02, 0.021, 0.1, 0.11, 1.0, 1.1, -0.1)] + [(None,)], "dy double")
    got = {r.faixa: r.quantidade for r in report.histogram(df, "dy", *report.DY_BINS).collect()}
    assert got == {"0-2%": 2, "2-4%": 1, "4-6%": 0, "6-8%": 0, "8-10%": 1, "10%+": 2}


def test_section_state(spark):
    from pyspark.sql import functions as F

    def state(*names, measured=False):
        df = spark.createDataFrame([(n,) for n in names], "status_modelos string")
        return report.section_state(df, F.lit(measured)).first().status

    assert [state("Baseline", "Ativo"), state("Baseline", "Aquecendo"), state("Aquecendo"), state(), state(measured=True)] == ["Ativo", "Baseline", "Aquecendo", "Sem dados", "Aquecendo"]


def test_ml_shadow_has_the_settings_of_the_operator(monkeypatch):
    from checks import catalog

    used = []
    monkeypatch.setattr(catalog, "training_set", lambda *_: None)
    monkeypatch.setattr(catalog, "_agreement", lambda found: found)
    monkeypatch.setattr(models, "shadow_run", lambda data, spec, horizon, given=None, *_: given or models.factories())
    monkeypatch.setattr(models, "forest", lambda t, trees=models.TREES: used.append(trees))
    monkeypatch.setattr(models, "random_splits", lambda t, trees=models.TREES: used.append(trees))
    monkeypatch.setattr(models, "boosted", lambda t, rounds, preset: used.append(rounds))
    found = catalog.ml_shadow(None, "")
    for name in list(found)[1:]:
        found[name](None)
    assert used == [models.TREES] * 2 + [models.ROUNDS] * 3
