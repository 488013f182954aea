"""Keyed state: upsert, accounting, due / fresh boundaries, imputation,
projection and the refresh cycle."""

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import refresh, state

def NOW():
    return F.lit("2025-10-03 22:00:00").cast("timestamp")
RATE_STATE = ("base_currency string, target_currency string, rates map<string,double>, date string, "
              "timestamp string, source string, is_fallback boolean, update_time string, crawl_time string")


def _rate_state(spark):
    rows = [
        ("EUR", "GBP", {"GBP": 0.86}, "2025-10-03", "2025-10-03 21:38:23", "fallback", True,
         "2025-10-03 21:38:23", "2025-10-03 21:38:23"),
        ("GBP", "EUR", {"EUR": 1.16}, "2025-10-03", "2025-10-03 21:38:26", "fallback", True,
         "2025-10-03 21:38:26", "2025-10-03 21:38:26"),
        ("JPY", "USD", {"USD": 0.0091}, "2025-10-03", "2025-10-03 21:38:29", "fallback", True,
         "2025-10-03 21:38:29", "2025-10-03 21:38:29"),
    ]
    return spark.createDataFrame(rows, RATE_STATE)


def test_change_projection_golden(spark):
    st = _rate_state(spark).drop("is_fallback")
    got = state.project_change(st, "rates", "target_currency", NOW()).select(
        "base_currency", "target_currency", "exchange_rate", "timestamp", "is_fallback").collect()
    assert [tuple(r) for r in got] == [
        ("EUR", "GBP", 0.86, "2025-10-03 21:38:23", False),
        ("GBP", "EUR", 1.16, "2025-10-03 21:38:26", False),
        ("JPY", "USD", 0.0091, "2025-10-03 21:38:29", False)]
    keep = state.project_change(_rate_state(spark), "rates", "target_currency", NOW())
    assert all(r.is_fallback for r in keep.collect())
    miss = state.project_change(st, "rates", F.lit("ZZZ"), NOW())
    assert all(r.exchange_rate is None for r in miss.collect())


def test_upsert_last_write_wins_and_idempotent(spark):
    s = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    b = spark.createDataFrame([(2, "b2", 2), (3, "c", 2), (3, "c-old", 1)], "k int, v string, seq int")
    once = state.upsert(s, b, "k", "seq", origin_col=None)
    twice = state.upsert(once, b, "k", "seq", origin_col=None)
    want = {(1, "a", 1), (2, "b2", 2), (3, "c", 2)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in twice.collect()} == want
    acc = state.upsert_accounting(s, b, "k").first()
    assert (acc.updated, acc.inserted, acc.total) == (1, 1, 3)


def test_upsert_hot_key(spark):
    # one key carries most rows; the aggregate still returns its newest row
    s = spark.range(0, 20000).select((F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0)).alias("k"),
                                     F.col("id").alias("seq"))
    got = state.latest_per_key(s, "k", "seq").where("k = 0").first()
    assert got.seq == 19999


def test_due_boundary_inclusive(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    last = spark.createDataFrame([("a", "2025-10-03 21:00:00"), ("b", "2025-10-03 21:00:01")], "k string, t string") \
                .withColumn("t", F.col("t").cast("timestamp"))
    d = {r.k: (r.reason, r.due) for r in state.due_keys(keys, last, "k", "t", NOW(), 3600).collect()}
    assert d == {"a": ("stale", True), "b": ("fresh", False), "c": ("new", True)}
    forced = state.due_keys(keys, last, "k", "t", NOW(), 3600, incremental=False)
    assert all(r.due for r in forced.collect())
    c = state.cycle_counts(state.due_keys(keys, last, "k", "t", NOW(), 3600)).first()
    assert (c.n_keys, c.n_due, c.n_skipped, c.n_new) == (3, 2, 1, 1)


def test_fresh_boundary_inclusive(spark):
    st = spark.createDataFrame([("a", "2025-10-03 21:00:00", True), ("b", "2025-10-03 20:59:59", False),
                                ("c", "not a time", None)], "k string, update_time string, is_fallback boolean")
    s = refresh.state_stats(st, "k", "update_time", "is_fallback", NOW(), 3600, 4).first()
    assert (s.total_records, s.covered_keys, s.fallback_records, s.fresh_records, s.coverage) == (3, 3, 1, 1, 0.75)


def test_impute(spark):
    df = spark.createDataFrame([("EUR", "GBP", None), ("USD", "CNY", 0.0), ("USD", "EUR", 0.9)],
                               "base string, target string, rate double")
    ref = state.fallback_rates_frame(spark).withColumnRenamed("rate", "ref")
    assert ref.count() == 13
    out = {(r.base, r.target): r for r in
           state.impute(df, "rate", ref, ["base", "target"], "ref", F.concat_ws("_", "base", "target")).collect()}
    assert out[("EUR", "GBP")].rate == 0.86 and out[("EUR", "GBP")].is_fallback
    r = out[("USD", "CNY")]
    assert r.is_fallback and r.source == "fallback" and fixed.RANDOM_RATE_LOW <= r.rate < fixed.RANDOM_RATE_HIGH
    again = state.impute(df, "rate", ref, ["base", "target"], "ref", F.concat_ws("_", "base", "target"))
    assert again.where("target = 'CNY'").first().rate == r.rate
    assert out[("USD", "EUR")].rate == 0.9 and not out[("USD", "EUR")].is_fallback


def test_pairs_and_regions(spark):
    p = refresh.pairs_frame(spark)
    assert p.count() == 18
    assert {r.base: 0 for r in p.collect()}.keys() == {"USD", "EUR", "GBP", "JPY"}
    df = spark.createDataFrame([("吉林",), ("广西",), ("上海",), ("重庆",), ("新疆",), ("北京",), ("台湾",)], "p string")
    got = [(r.region, r.t) for r in df.select(refresh.region_of("p").alias("region")).select(
        "region", refresh.temperature_text("region").alias("t")).collect()]
    assert got == [("东北", "5℃-15℃"), ("华南", "15℃-28℃"), ("华东", "10℃-22℃"), ("西南", "12℃-24℃"),
                   ("西北", "3℃-18℃"), ("华北", "8℃-20℃"), ("华北", "8℃-20℃")]


def test_refresh_cycle(spark):
    st = _rate_state(spark)
    snap = spark.createDataFrame([("USD", "EUR", 0.92), ("USD", "AUD", None), ("EUR", "GBP", 0.87)],
                                 "base_currency string, target_currency string, rate double")
    now = F.lit("2025-10-03 22:00:00").cast("timestamp")
    out = refresh.refresh_rates(spark, st, snap, now, 3600)
    c = out["counts"].first()
    assert (c.n_keys, c.n_due, c.n_skipped, c.n_new) == (18, 15, 3, 15)
    new = {(r.base_currency, r.target_currency): r for r in out["new_state"].collect()}
    assert len(new) == 18
    assert new[("USD", "EUR")].rates == {"EUR": 0.92} and not new[("USD", "EUR")].is_fallback
    assert new[("USD", "CAD")].rates == {"CAD": 1.25} and new[("USD", "CAD")].is_fallback
    assert new[("EUR", "GBP")].update_time == "2025-10-03 21:38:23"   # fresh: untouched
    ch = out["changes"].collect()
    assert len(ch) == 15 and all(r.update_time == "2025-10-03 22:00:00" for r in ch)


def test_success_rate(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, False), (2, True)], "g int, failed boolean")
    r = {x.g: x.success_rate for x in refresh.success_rate(df, "g", F.col("failed")).collect()}
    assert r == {1: 66.6667, 2: 0.0}


def test_weather_defaults_and_coverage(spark):
    rows = [("北京", None, None, None, None, None), ("广东", "2025-10-03", "晴", "15℃-28℃", "东风2级", "weather.cma.cn")]
    df = spark.createDataFrame(rows, "province string, date string, weather string, temperature string, "
                                     "wind string, source string")
    out = {r.province: r for r in refresh.fill_weather_defaults(df, NOW()).collect()}
    b = out["北京"]
    assert (b.weather, b.temperature, b.wind, b.source, b.is_fallback, b.date) == (
        "多云", "10°C-20°C", "微风", "fallback", True, "2025-10-03")
    assert out["广东"].weather == "晴" and not out["广东"].is_fallback
    assert len(fixed.PROVINCES) == 34 and len(set(fixed.PROVINCES)) == 34
    st = refresh.fill_weather_defaults(df, NOW()).withColumn("update_time", F.lit("2025-10-03 21:30:00"))
    s = refresh.state_stats(st, "province", "update_time", "is_fallback", NOW(), 3600, len(fixed.PROVINCES)).first()
    assert (s.covered_keys, s.fallback_records, s.fresh_records, s.coverage) == (2, 1, 2, round(2 / 34, 4))


def test_refresh_weather(spark):
    st = spark.createDataFrame([], refresh.WEATHER_STATE_SCHEMA)
    snap = spark.createDataFrame([("广东", "2025-10-03", "晴", "15℃-28℃", "东风2级", "weather.cma.cn"),
                                  ("北京", None, None, None, None, None)], refresh.WEATHER_SNAPSHOT_SCHEMA)
    out = refresh.refresh_weather(spark, st, snap, NOW(), 3600)
    c = out["counts"].first()
    assert (c.n_keys, c.n_due, c.n_new) == (34, 34, 34)
    new = {r.province: r for r in out["new_state"].collect()}
    assert len(new) == 34 and new["广东"].weather == "晴" and new["广东"].is_fallback is None
    assert new["北京"].weather == "多云" and new["北京"].is_fallback and new["北京"].source == "fallback"
    s = out["stats"].first()
    assert (s.covered_keys, s.fallback_records, s.fresh_records, s.coverage) == (34, 33, 34, 1.0)
    again = refresh.refresh_weather(spark, out["new_state"], snap, NOW(), 3600)
    assert again["counts"].first().n_due == 0


def test_unify_rate_states(spark):
    nested = spark.createDataFrame([("EUR", "GBP", {"GBP": 0.86}, True)],
                                   "base_currency string, target_currency string, rates map<string,double>, is_fallback boolean")
    flat = spark.createDataFrame([("USD", "JPY", 110.5, "2025-10-03")],
                                 "base_currency string, target_currency string, exchange_rate double, date string")
    u = {(r.base_currency, r.target_currency): r for r in refresh.unify_rate_states(nested, flat).collect()}
    assert u[("EUR", "GBP")].exchange_rate == 0.86 and u[("EUR", "GBP")].date is None
    assert u[("USD", "JPY")].rates == {"JPY": 110.5} and u[("USD", "JPY")].is_fallback is None


def test_source_counts(spark):
    flat = spark.createDataFrame([("USD", "EUR", 0.92, "api"), ("USD", "JPY", 110.5, "fallback"),
                                  ("EUR", "GBP", 0.86, "fallback"), ("GBP", "USD", 1.3, None)],
                                 "base_currency string, target_currency string, exchange_rate double, source string")
    c = refresh.source_counts(flat).first()
    assert (c.total_records, c.api_records, c.fallback_records) == (4, 1, 2)
