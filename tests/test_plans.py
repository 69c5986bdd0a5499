"""Golden values of operators and analyses on small tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cosecha.operators import asof, panel, quantiles, rows, terms
from cosecha.plans import catalog, history, international, master, models, pages, prices, production, trees, water
from cosecha.sources import files
from cosecha.streaming import incremental, refresh

D = lambda m, d: dt.date(2026, m, d)
WHOLESALE = "fecha date, cultivo string, mercado string, origen string, precio double, precio_minimo double, precio_maximo double"


def wholesale(spark, data):
    return spark.createDataFrame([(f, c, m, "o", float(p), float(p), float(p)) for f, c, m, p in data], WHOLESALE)


def test_price_lags_and_targets(spark):
    w = wholesale(spark, [(D(1, 1) + dt.timedelta(i), "papa", "a", 40 + i) for i in range(40)])
    got = {r["fecha"]: r for r in prices.features(w).collect()}
    assert got[D(1, 8)]["lag_7"] == 40
    assert got[D(1, 1)]["objetivo_7"] == 47
    assert got[D(1, 1)]["alza_15_7"] == 1 and got[D(2, 9)]["alza_10_7"] is None
    assert got[D(1, 2)]["media_7"] is None and got[D(1, 3)]["media_7"] == 40.5


def test_bounded_fill(spark):
    w = wholesale(spark, [(D(1, 1), "papa", "a", 10), (D(1, 7), "papa", "a", 20), (D(1, 7), None, "a", 1)])
    got = [(r["precio"], r["n"]) for r in prices.daily_panel(w).orderBy("fecha").collect()]
    assert got == [(10, 1), (10, 0), (10, 0), (10, 0), (None, 0), (None, 0), (20, 1)]


def test_weekly_comparison(spark):
    w = wholesale(spark, [(D(1, 5), "papa", "a", 11), (D(1, 5), "papa", "b", 19), (D(1, 6), "papa", "a", 11), (D(1, 6), "papa", "b", 19), (D(1, 12), "papa", "a", 15)])
    s = spark.createDataFrame([(D(1, 5), "papa", 33.0, 30.0), (D(1, 12), "papa", 21.0, None)], "fecha date, cultivo string, precio_uno double, precio_dos double")
    one, two = prices.weekly(w, s).orderBy("semana").collect()
    assert (one["mediana"], one["minimo"], one["maximo"], one["mercados"], one["precio_uno"], one["precio_dos"], one["dias"]) == (15, 11, 19, 2, 33, 30, 2)
    assert two["cambio"] == 0 and two["cambio_uno"] == pytest.approx(21 / 33 - 1) and two["spread_uno"] == pytest.approx(0.4) and not two["hay_dos"]


def test_empty_inputs(spark):
    w = wholesale(spark, [])
    assert prices.features(w).count() == 0 and prices.main_origins(w).count() == 0
    assert models.cutoff(w, "fecha").count() == 0


DAMS = "presa long, estado string, anio int, mes int, decena int, fecha date, pct double, hm3 double, namo double, name double"


def test_dam_features(spark):
    d = spark.createDataFrame([(1, "X", 2026, 1 + i // 3, 1 + i % 3, D(1 + i // 3, [10, 20, 28][i % 3]), 80.0 - i, 1.0, -1.0, 50.0) for i in range(7)], DAMS)
    got = water.features(d).orderBy("fecha").collect()
    assert got[1]["lag_1"] == 80 and got[0]["objetivo_3"] == 77 and got[0]["delta_3"] == -3
    state = water.states(d).orderBy("fecha").first()
    assert state["ponderado"] == 80 and state["presas"] == 1 and state["bajo_40"] == 0 and state["capacidad"] == 50


def test_climate_keeps_the_dams_columns(spark):
    d = spark.createDataFrame([(1, "X", 2026, 1, 1, D(1, 10), 80.0, 1.0, 1.0, 1.0)], DAMS)
    c = spark.createDataFrame([(1, D(1, 10), 5.0, 21.0, 2.0, "otro")], "presa long, fecha date, lluvia double, temperatura double, evaporacion double, estado string")
    assert water.features(d, c).first()["estado"] == "X"


def test_weather_of_a_decena(spark):
    w = spark.createDataFrame([(1, D(1, 1), 2.0, 20.0, 1.0), (1, D(1, 2), 3.0, 22.0, 1.0)], "presa long, fecha date, lluvia double, temperatura double, evaporacion double")
    r = water.climate_decenas(w).first()
    assert (r["lluvia"], r["temperatura"], r["fecha"], r["dias"]) == (5, 21, D(1, 10), 2)
    assert water.new_window(spark.createDataFrame([(dt.date(2026, 3, 31),)], "fecha date"), "2020-01-01").first()["desde"] == dt.date(2026, 2, 19)


def test_baseline_forecast(spark):
    progress = spark.createDataFrame([("papa", "X", 2026, 5, 100.0, 1, 1, 0, 70.0, D(5, 31))], "cultivo string, estado string, anio int, mes int, prod_mes double, sembrada long, cosechada long, siniestrada long, acumulada double, corte date")
    annual = spark.createDataFrame([("papa", "X", 2025, 120.0, 2.0), ("papa", "X", 2020, 60.0, 1.0)], "cultivo string, estado string, anio int, produccion double, rendimiento double")
    r = production.forecast(production.features(progress, annual)).first()
    assert (r["pronostico"], r["tipo_referencia"], r["cambio_pct"]) == (120, "anio_anterior", 0)
    assert r["media_5"] == 90 and r["sequia"] == pytest.approx(102)
    calendar = {x["anio"]: x for x in production.calendar_references(annual).collect()}
    assert calendar[2025]["anterior"] is None and calendar[2025]["media_5"] == 60


def test_master_values(spark):
    w = wholesale(spark, [(D(1, 1), "papa", "a", p) for p in (10, 20, 30)] + [(D(1, 1), None, "a", 5)])
    r = master.wholesale_daily(w).where("cultivo = 'papa'").first()
    assert (r["media"], r["mediana"], r["minimo"], r["maximo"], r["n"]) == (20, 20, 10, 30, 3)
    assert master.wholesale_daily(w).count() == 2
    shop = spark.createDataFrame([(D(1, 1), "papa", "uno", 49.0, 99.0), (D(1, 2), "papa", "uno", None, 15.0)], "fecha date, cultivo string, fuente string, precio_kg double, precio_unidad double")
    assert [(x["comparable"], x["base"]) for x in master.retail_daily(shop).orderBy("fecha").collect()] == [(49, "por_kg"), (15, "por_unidad")]
    annual = spark.createDataFrame([(2025, "papa", "t", 10.0, 100.0), (2025, "papa", "t", 20.0, 300.0), (2025, "papa", "t", 9.0, 0.0)], "anio int, cultivo string, unidad string, precio double, produccion double")
    a = master.annual_prices(annual).first()
    assert (a["precio"], a["filas"], a["produccion"]) == (17.5, 2, 400)


def test_exchange_rate_as_of(spark):
    p = spark.createDataFrame([(D(1, 3), 2.0, "USD"), (D(1, 1), 2.0, "MXN"), (dt.date(2025, 12, 1), 1.0, "USD")], "fecha date, precio double, moneda string")
    fx = spark.createDataFrame([(D(1, 1), 17.0)], "fecha date, tasa double")
    assert {r["fecha"]: r["valor"] for r in international.in_pesos(p, fx).collect()} == {D(1, 3): 34, D(1, 1): 2, dt.date(2025, 12, 1): None}


def test_asof_tolerance_is_inclusive(spark):
    left = spark.createDataFrame([("a", D(2, 15)), ("a", D(2, 16)), ("b", D(2, 1)), ("a", None)], "k string, t date")
    right = spark.createDataFrame([("a", D(1, 1), 5)], "k string, at date, v int")
    got = {(r["k"], r["t"]): r["v"] for r in asof.asof_join(left, right, ("t", "at"), ["k"], 45).collect()}
    assert got == {("a", D(2, 15)): 5, ("a", D(2, 16)): None, ("b", D(2, 1)): None, ("a", None): None}


def test_asof_with_repeated_days_and_null_keys(spark):
    series = spark.createDataFrame([(D(1, 5), 1), (D(1, 5), 7), (D(1, 9), 3), (None, 4)], "at date, v int")
    left = spark.createDataFrame([(D(1, d), d) for d in (4, 5, 6, 9, 30)] + [(None, 0)], "t date, i int")
    got = sorted((r["i"], r["v"]) for r in asof.asof_series(left, series, ("t", "at")).collect())
    assert got == [(0, None), (4, None), (5, 7), (6, 7), (9, 3), (30, 3)]
    keyed = series.withColumn("k", F.when(F.col("v") != 3, F.lit("a")))
    own = left.withColumn("k", F.when(F.col("i") != 30, F.lit("a")))
    got = sorted((r["i"], r["v"]) for r in asof.asof_join(own, keyed, ("t", "at"), ["k"]).collect())
    assert got == [(0, None), (4, None), (5, 7), (6, 7), (9, 7), (30, None)]
    assert asof.asof_join(own.limit(0), keyed, ("t", "at"), ["k"]).count() == 0 and asof.asof_join(own, keyed.limit(0), ("t", "at"), ["k"]).count() == 6


def test_names_inside_words_and_states(spark):
    known = spark.createDataFrame([("el_cuchillo", "x"), ("la_boca", "x"), ("la_boca", "y"), ("boca_chica", "y")], "k string, w string")
    asked = spark.createDataFrame([("cuchi", None), ("la_boca", "y"), ("la_boca", None), ("boca", "x"), ("chillo", "y"), ("", None), (None, None)], "q string, w string")
    got = {(r["q"], r["w"]): (r["match"], r["status"]) for r in asof.resolve_names(asked, known, "q", "k", "w").collect()}
    assert got == {("cuchi", None): ("el_cuchillo", "found"), ("la_boca", "y"): ("la_boca", "found"), ("la_boca", None): (None, "ambiguous"), ("boca", "x"): ("la_boca", "found"), ("chillo", "y"): (None, "missing"), ("", None): (None, "missing"), (None, None): (None, "missing")}


def test_names(spark):
    asked = spark.createDataFrame([("el_cuchillo",), ("cuchillo",), ("presa",), ("nada",)], "q string")
    known = spark.createDataFrame([("el_cuchillo",), ("presa_uno",), ("presa_dos",)], "k string")
    got = {r["q"]: (r["match"], r["status"]) for r in asof.resolve_names(asked, known, "q", "k").collect()}
    assert got == {"el_cuchillo": ("el_cuchillo", "found"), "cuchillo": ("el_cuchillo", "found"), "presa": (None, "ambiguous"), "nada": (None, "missing")}


def test_upsert_and_checks(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int")
    new = spark.createDataFrame([("A", 9), ("C", 3)], "k string, v int")
    assert sorted(map(tuple, rows.upsert(old, new, ["k"]).collect())) == [("A", 9), ("B", 2), ("C", 3)]
    good, bad = rows.checked(old, {"grande": F.col("v") > 1})
    assert good.count() == 1 and bad.first()["errors"] == ["grande"]
    marked = spark.createDataFrame([("Frutas", "Frutas"), ("x", "1"), (None, " ")], "a string, b string")
    assert rows.without_markers(marked, ["a", "b"], ["Frutas"]).collect() == [("x", "1")]


def test_history(spark):
    cols = "tipo string, cultivo string, estado string, anio int, prioridad int, " + ", ".join(f"m{i:02d} double" for i in range(1, 13))
    w = spark.createDataFrame([("SIEMBRA", "papa", "X", 2024, 1, *[11.0] * 11, 0.0), ("SIEMBRA", "papa", "X", 2024, 2, *[99.0] * 12), ("COSECHA", "papa", "X", 2024, 1, *[0.0] * 12)], cols)
    got = {r["mes"]: (r["SIEMBRA"], r["COSECHA"]) for r in history.side_by_side(history.months_long(w)).collect()}
    assert got[1] == (11, 0) and got[12] == (99, 0)


def test_periods(spark):
    p = catalog.periods(spark, (2025, 1, 2), (2025, 12, 3)).orderBy("fecha").collect()
    assert len(p) == 35 and tuple(p[-1])[:3] == (2025, 12, 3)
    runs = spark.createDataFrame([("a", "ok"), ("a", "error"), ("b", "omitida")], "grupo string, estado string")
    assert {r["grupo"]: r["resultado"] for r in catalog.run_summary(runs).collect()} == {"a": "partial", "b": "skipped"}


def test_method_choice_and_trace(spark):
    t = spark.createDataFrame([(10.0, 10.0, 0.0), (20.0, 20.0, None), (0.0, 0.0, 5.0)], "a double, exact double, bad double")
    m = models.metrics(t, "a", {"base": F.col("exact"), "modelo": F.col("bad")})
    assert models.choose(m).first()["metodo"] == "base"
    forced = models.choose(m, "modelo").first()
    assert forced["metodo"] == "modelo" and forced["forzado"] and forced["n"] == 2


def test_robust_z_falls_back(spark):
    d = spark.createDataFrame([("a", x) for x in (1.0, 1.0, 1.0, 5.0)], "k string, x double")
    z = sorted(r["robust_z"] for r in panel.robust_z(d, ["k"], "x").collect())
    assert z[0] == 0 and z[-1] == pytest.approx(0.6745 * 4 / 2)


def test_html_tables(spark):
    html = "<table><tr><th>a</th></tr></table><table><tr><th>Cultivo</th><th>Precio</th></tr><tr><td>Papa &amp; col</td><td>1,200</td></tr></table>"
    cells = pages.tables(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"))
    assert [tuple(r)[2:] for r in pages.report_table(cells).orderBy("column").collect()] == [("cultivo", "Papa & col"), ("precio", "1,200")]


def test_report_headers(spark):
    plain = "<table><tr><td>Precio</td><td>Precio</td><td></td></tr><tr><td>7</td><td>8</td><td>x</td></tr><tr><td> </td><td></td><td></td></tr><tr><td>y</td><td></td><td></td></tr></table>"
    two = '<table><tr><th rowspan=2>Entidad</th><th colspan="2">Superficie (ha)</th></tr><tr><th>Sembrada</th><th>Unnamed: 1</th></tr><tr><td rowspan="2">Sonora</td><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>'
    cells = pages.tables(spark.createDataFrame([(1, plain), (2, two), (3, "<table><tr><th>solo</th></tr></table>"), (4, "<p>none")], "page_id long, html string"))
    got = pages.numeric_columns(pages.report_table(cells)).collect()
    rows_ = lambda n: sorted((r["row_no"], r["column"], r["value"], r["number"]) for r in got if r["page_id"] == n)
    assert rows_(1) == [(1, "numero", "x", None), (1, "precio", "7", None), (3, "numero", None, None), (3, "precio", "y", None)]
    assert rows_(2) == [(2, "entidad", "Sonora", None), (2, "superficie_ha", "2", 2), (2, "superficie_sembrada_ha", "1", 1), (3, "entidad", "Sonora", None), (3, "superficie_ha", "4", 4), (3, "superficie_sembrada_ha", "3", 3)]
    assert rows_(3) == rows_(4) == []


def test_trees_as_a_method(spark, tmp_path):
    """Trees win where the simple methods know nothing of what decides, are saved, and leave unknown categories alone."""
    t = [(h, D(1, 1) + dt.timedelta(i), "ab"[i % 2], float(i % 2 * 10), None, 5.0) for h in (1, 2) for i in range(40)]
    target = models.marked(spark.createDataFrame(t, "horizonte int, fecha date, k string, objetivo double, nada double, precio double"), "fecha")
    newest = spark.createDataFrame([(1, "b", None, 5.0), (2, "c", None, 5.0)], "horizonte int, k string, nada double, precio double")
    make = lambda **more: models.trained(target, newest, {"persistencia": F.col("precio")}, [models.Candidate("arboles")], ["nada", "precio"], ["k"], ["fecha"], fallback="persistencia", **(dict(trees=1, depth=1, rate=1.0, share=1.0, columns=1.0, l2=0.0) | more))
    r = make(folder=f"file://{tmp_path}/m")
    assert {(c["metodo"], c["motivo"], c["mae"]) for c in r.choice.collect()} == {("arboles", "menor_mae", 0.0)}
    assert r.newest.where("horizonte = 1").first()["arboles"] == 10
    assert {x["variable"] for x in r.importances.collect()} <= {"k_a", "k_b"}
    again = trees.read_models(f"file://{tmp_path}/m", spark)
    ahead = trees.predicted(newest, {m.fit.group: m for m in again.values()}, "otra_vez").collect()
    assert sorted(again) == ["arboles_1_final", "arboles_2_final"] and {x["k"]: x["otra_vez"] for x in ahead} == {x["k"]: x["arboles"] for x in r.newest.collect()}
    few = make(least=100)
    assert {(c["metodo"], c["motivo"]) for c in few.choice.collect()} == {("persistencia", "pocas_filas")} and few.importances is None
    with pytest.raises(ValueError, match="no such method"):
        models.chosen(target, {"persistencia": F.col("precio")}, "persistencia", "otro")


def test_staged_refresh(spark, tmp_path):
    ok, bad = (lambda done: spark.range(2)), (lambda done: 1 / 0)
    run = lambda version, *stages: [(r["etapa"], r["estado"]) for r in refresh.refresh(spark, f"file://{tmp_path}/r", stages, version).orderBy("orden").collect()]
    s = refresh.Stage
    assert run("1", s("a", bad, True), s("b", ok)) == [("a", "error"), ("b", "not_run")]
    assert run("2", s("a", ok), s("b", ok)) == [("a", "updated"), ("b", "updated")]
    assert run("3", s("a", bad, True), s("b", bad)) == [("a", "stale_fallback"), ("b", "error")]
    assert run("4", s("a", lambda done: None), s("b", ok)) == [("a", "skipped_existing"), ("b", "not_run")]


def test_optional_sources(spark):
    wide = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    got = master.coverage(wide, ["a", "b"], {"b": spark.range(0)}).collect()
    assert sorted((r["fuentes"], r["faltan"], r["cobertura"]) for r in got) == [(0, 1, 0), (1, 0, 1)]
    assert {r["faltan"] for r in master.coverage(wide, ["a", "b"], {"b": spark.range(1)}).collect()} == {1, 2}


def test_file_scan_and_sinks(spark, tmp_path):
    for day, price in (("2026-01-01", 10), ("2026-01-02", 12)):
        folder = tmp_path / "runs" / day / "wholesale"
        folder.mkdir(parents=True)
        (folder / f"sniim_{day}.csv").write_text(f"Producto canonico,Destino,Origen,Precio Frec,Fecha\nTomate,DF,Sonora,{price},05/01/2026\nTomate,DF,Sonora,x,\n", encoding="utf-8")
    scanned = files.scan(spark, f"file://{tmp_path}/runs", "sniim_*")
    got = files.wholesale_history(scanned).orderBy("precio_frecuente").collect()
    assert [(r["fecha"], r["cultivo_canonico"], r["precio_frecuente"]) for r in got] == [(D(1, 5), "tomate_rojo", 10), (D(1, 5), "tomate_rojo", 12)]
    newest = files.latest_exports(scanned, F.lit("p"), F.lit(2026), F.lit(1))
    assert newest.select("source_file").distinct().count() == 1
    info = files.write_table(files.wholesale_history(scanned), f"file://{tmp_path}/out", "fecha", ["mercado"]).first()
    assert info["filas"] == 2 and info["distintos_mercado"] == 1
    files.publish(spark.range(3), f"file://{tmp_path}/pub", "1")
    assert files.published(spark, f"file://{tmp_path}/pub").count() == 3
    files.publish(spark.range(5), f"file://{tmp_path}/pub", "0-again")
    assert files.published(spark, f"file://{tmp_path}/pub").count() == 5


def test_public_series(spark):
    wide = spark.createDataFrame([("2026M01", "1.5", "…"), ("2026M02", "2", "3")], "mes string, cafe string, `te verde` string")
    assert sorted((r["fecha"].month, r["serie"], r["precio_original"]) for r in files.wide_series(wide, "mes").collect()) == [(1, "cafe", 1.5), (2, "cafe", 2), (2, "te verde", 3)]
    fx = spark.createDataFrame([("2026-01-01", "."), ("2026-01-02", "17.5")], "observation_date string, DEXMXUS string")
    assert files.fx_rates(fx).count() == 1
    usda = spark.createDataFrame([("2026-01-01", "limes", "40", "44")], "date string, commodity string, low_price string, high_price string")
    assert files.mid_prices(usda).first()["precio_original"] == 42


def test_stream_by_day_and_upsert(spark, tmp_path):
    source = str(tmp_path / "in")
    e = spark.createDataFrame([(dt.datetime(2026, 1, 1, 5), "a", 1.0), (dt.datetime(2026, 1, 1, 6), "a", 2.0), (dt.datetime(2026, 3, 1), "a", 9.0)], "ts timestamp, event_type string, value double")
    e.coalesce(1).write.parquet(source)
    stream = incremental.by_decena(spark.readStream.schema(e.schema).parquet(source))
    stream.writeStream.format("memory").queryName("days").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert [(r["n"], r["suma"]) for r in spark.table("days").collect()] == [(2, 3.0)]
    keyed = spark.readStream.schema(e.schema).parquet(source).select("event_type", F.to_date("ts").alias("fecha"), "value")
    table = str(tmp_path / "table")
    for check in ("check", "check", "other"):  # a second batch, and a checkpoint that starts anew
        incremental.upsert_stream(keyed, table, ["event_type", "fecha"], str(tmp_path / check), "fecha").awaitTermination()
        more = spark.createDataFrame([(dt.datetime(2026, 3, 1), "a", 11.0), (dt.datetime(2026, 4, 1), "b", 1.0)], e.schema)
        more.coalesce(1).write.mode("append").parquet(source)
    want = {D(1, 1): 2.0, dt.date(2026, 3, 1): 11.0, dt.date(2026, 4, 1): 1.0}
    assert {r["fecha"]: r["value"] for r in spark.read.parquet(table).collect()} == want and spark.read.parquet(table).count() == 3


def test_asof_far_dates_and_buckets(spark):
    """A far date adds a row and no more; answers come over many buckets, at the same time and after it."""
    rng = np.random.default_rng(4)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(int(n))
    right = [(str(k), day(n), int(v)) for k, n, v in zip(rng.integers(0, 4, 60), rng.integers(0, 900, 60), rng.integers(0, 99, 60), strict=True)]
    left = [(str(k), day(n), i) for i, (k, n) in enumerate(zip(rng.integers(0, 5, 300), rng.integers(-50, 1000, 300), strict=True))] + [("1", dt.date(9999, 12, 31), 300)]
    r, own = spark.createDataFrame(right, "k string, at date, v int"), spark.createDataFrame(left, "k string, t date, i int")
    for tolerance in (None, 20):
        for bucket in (1, 7, 64):
            got = {x["i"]: (x["at"], x["v"]) for x in asof.asof_join(own, r, ("t", "at"), ["k"], tolerance, bucket).collect()}
            want = {}
            for k, t, i in left:
                past = max(((at, v) for key, at, v in right if key == k and at <= t and (tolerance is None or (t - at).days <= tolerance)), default=(None, None))
                want[i] = past
            assert got == want


def test_asof_of_timestamps(spark):
    T = lambda h, m=0: dt.datetime(2024, 3, 1, h, m)
    right = spark.createDataFrame([("a", T(1), 1), ("a", T(1, 30), 2), ("a", T(9), 3)], "k string, at timestamp, v int")
    left = spark.createDataFrame([("a", T(0, 59), 0), ("a", T(1), 1), ("a", T(1, 29), 2), ("a", T(8), 3), ("a", T(23), 4)], "k string, t timestamp, i int")
    assert {x["i"]: x["v"] for x in asof.asof_join(left, right, ("t", "at"), ["k"]).collect()} == {0: None, 1: 1, 2: 1, 3: 2, 4: 3}


def test_terms_in_texts(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("ab c"), rng.integers(1, 9))) for _ in range(120)]
    terms_ = [(int(rng.integers(0, 2)), "".join(rng.choice(list("abc"), rng.integers(1, 6)))) for _ in range(60)] + [(0, ""), (0, None), (None, "a"), (1, "zzz")]
    texts = [(int(rng.integers(0, 2)), w) for w in words] + [(0, None), (None, "abc")]
    got = {tuple(r) for r in terms.held_in(spark.createDataFrame(terms_, "grupo int, termino string"), spark.createDataFrame(texts, "grupo int, texto string")).collect()}
    assert got == {(g, t, x) for g, t in terms_ for h, x in texts if g is not None and g == h and t and x is not None and t in x}


def plain_boosting(x, y, nominal, n_trees, depth, rate, l2):
    """Boosted trees over bins, one node and one cut at a time."""
    told, trees_ = np.full(len(y), y.mean()), []
    gains = {}

    def grow(rows, level):
        g = told[rows] - y[rows]
        value = -rate * g.sum() / (len(rows) + l2)
        best = (0.0,)
        for f in range(x.shape[1]) if level < depth else ():
            for b in sorted(set(x[rows, f])):
                left = x[rows, f] == b if nominal[f] else x[rows, f] <= b
                if 0 < left.sum() < len(rows):
                    score = lambda s: g[s].sum() ** 2 / (s.sum() + l2)
                    gain = score(left) + score(~left) - g.sum() ** 2 / (len(rows) + l2)
                    if gain > best[0] * (1 + 1e-9) and gain > 1e-9:
                        best = (gain, f, b, left)
        if len(best) == 1:
            return np.full(len(rows), value)
        gains.setdefault(best[1], []).append(best[0])
        out = np.empty(len(rows))
        for side in (best[3], ~best[3]):
            out[side] = grow(rows[side], level + 1)
        return out

    for _ in range(n_trees):
        told = told + grow(np.arange(len(y)), 0)
    return told, gains


def test_trees_against_plain_loops(spark):
    """Two models at once, numbers with gaps and a category: predictions and gains of the plain learner."""
    rng = np.random.default_rng(6)
    n = 400
    a, b, k = rng.integers(0, 12, n).astype(float), rng.normal(size=n).round(1), rng.choice(list("uvw"), n)
    y = np.where(k == "u", a * 2, b * 5) + rng.normal(size=n)
    gap = rng.random(n) < 0.1
    rows_ = [(h, bool(i % 5 == 0), i, None if gap[i] else float(a[i]), float(b[i]), str(k[i]), float(y[i] * h)) for h in (1, 2) for i in range(n)]
    df = spark.createDataFrame(rows_, "horizonte int, prueba boolean, i int, a double, b double, k string, objetivo double").repartition(5)
    fits = [trees.Fit(f"m{h}{last:d}", h, "objetivo", last) for h in (1, 2) for last in (False, True)]
    got = trees.boosted(df, fits, ["a", "b"], ["k"], ["i"], trees=4, depth=3, rate=0.5, share=1.0, columns=1.0)
    for h in (1, 2):
        for last in (False, True):
            m = got[f"m{h}{last:d}"]
            use = np.array([last or i % 5 != 0 for i in range(n)])
            filled = np.where(gap, np.sort(a[use & ~gap])[(int(np.ceil((use & ~gap).sum() * 0.5))) - 1], a)
            bins = np.stack([np.searchsorted(m.layout.cuts[0], filled, "left"), np.searchsorted(m.layout.cuts[1], b, "left"), np.array(["uvw".index(v) for v in k])], 1)
            want, gains = plain_boosting(bins[use], y[use] * h, [False, False, True], 4, 3, 0.5, 1.0)
            told = {r["i"]: r["p"] for r in trees.predicted(df.where(F.col("horizonte") == h), {h: m}, "p").collect()}
            assert [told[i] for i in np.flatnonzero(use)] == pytest.approx(list(want))
            mean = {name: np.mean(sum((v for f, v in gains.items() if (f == 2) == (name[0] == "k")), [])) for name in ("k",) if 2 in gains}
            total = sum(g / c for g, c in m.gains.values())
            assert sum(s for _, s in m.importances(100)) == pytest.approx(1) and sum(g for name, (g, c) in m.gains.items() if name[0] == "k") == pytest.approx(sum(gains.get(2, [])))
            assert mean and total > 0


def test_trees_see_a_share_of_rows(spark):
    ids = np.arange(20_000)
    shares = [trees._share(ids, t, 0.85, 42).mean() for t in range(5)]
    assert all(abs(s - 0.85) < 0.01 for s in shares) and (trees._share(ids, 0, 0.85, 42) != trees._share(ids, 1, 0.85, 42)).any()


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_exact_quantiles(spark, accuracy):
    rng = np.random.default_rng(2)
    values = {"a": rng.normal(size=5000).round(2), "b": np.repeat(3.0, 7), "c": np.array([1.0, 2.0]), None: rng.exponential(size=900)}
    data = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("d", None), ("a", float("nan"))]
    got = {r["k"]: tuple(r)[1:] for r in quantiles.exact_quantiles(spark.createDataFrame(data, "k string, x double").repartition(6), ["k"], "x", (0.1, 0.5, 0.9, 1.0), accuracy).collect()}
    assert got.keys() == values.keys()
    for k, vs in values.items():
        assert got[k] == pytest.approx([float(np.quantile(vs, q)) for q in (0.1, 0.5, 0.9, 1.0)], abs=1e-12)
    whole = quantiles.exact_quantiles(spark.createDataFrame(data, "k string, x double"), [], "x", (0.25,), accuracy).first()
    assert whole["q1"] == pytest.approx(float(np.quantile(np.concatenate(list(values.values())), 0.25)))
