"""Monthly series against published results and on edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import series as M

# 48 monthly totals (sales, profit, orders) of 2011 to 2014.
MONTHS = """
98902 8321.801 216;91152 12417.907 183;145726 15303.5683 277;116927 12902.3244 267;146762 12183.8287 295;215214 23415.247 468
115518 5585.0035 250;207570 23713.6677 443;290230 35776.8839 527;199070 25963.4183 401;298499 32709.1777 563;333941 40647.984 620
135775 10401.6376 260;100521 15000.0962 230;163092 17992.9176 337;161060 17366.9672 322;208370 29876.7037 413;256181 34407.1536 571
145247 15585.3884 324;303158 43573.8786 522;289390 27776.1803 641;252942 30662.8827 499;323512 31820.7218 716;338245 32950.7513 628
199197 26810.5597 345;167247 25340.0261 306;198591 23433.7746 411;177835 19462.0384 394;260525 28495.6941 522;396513 45478.4134 724
229940 28863.8272 447;326491 31023.6685 692;376626 38905.6678 836;293423 42433.2226 580;373996 48062.9967 789;405476 50202.8711 825
241267 28001.3863 450;184848 19751.7 385;263110 37357.2605 530;242781 23782.3012 523;288404 33953.5577 667;401843 43778.6028 899
258718 28035.8726 540;456633 53542.895 843;481186 67979.4511 1017;422785 58209.8348 810;555312 62856.5879 1077;503154 46916.5207 1093
"""
# Published forecast, seasonality and sample rows of growth, average and smoothing.
FORECAST = [349892.96, 323616.73, 374913.15, 361318.41, 409691.61, 495870.78]
SEASONALITY = [0.6408, 0.5161, 0.7313, 0.6631, 0.8581, 1.2052, 0.7113, 1.2281, 1.3643, 1.1088, 1.4724, 1.5004]
SMOOTH = {0: 98902.0, 1: 98902.0, 2: 96189.5, 3: 113527.275, 12: 271635.9257, 24: 297793.8598, 47: 458392.5575}
GROWTH = {1: (-0.0784, 0.4922), 7: (0.7969, 3.246), 47: (-0.0939, -0.2536)}
AVERAGE = {2: (111926.6667, 12014.4254), 47: (493750.3333, 55994.3144)}


@pytest.fixture(scope="module")
def monthly(spark):
    cells = [part.split() for row in MONTHS.split("\n") if row.strip() for part in row.split(";")]
    rows = [
        (dt.date(2011 + i // 12, i % 12 + 1, 1), float(s), float(p), int(n)) for i, (s, p, n) in enumerate(cells)
    ]
    assert len(rows) == 48
    return spark.createDataFrame(rows, "month date, sales double, profit double, orders long")


def in_order(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy(df.columns[0]).collect()]


def test_forecast(monthly):
    rows = in_order(M.sales_forecast(monthly), "forecast_month", "forecast_sales")
    assert [d for d, _ in rows] == [dt.date(2015, m, 1) for m in range(1, 7)]
    assert [round(v, 2) for _, v in rows] == FORECAST
    line = in_order(M.history_and_forecast(monthly, M.sales_forecast(monthly)), "forecast_month", "forecast_sales")
    assert line[0] == (dt.date(2014, 12, 1), 503154.0) and len(line) == 7


def test_trend(monthly):
    fit = M.trend_fit(monthly, "sales").first()
    assert (round(fit["slope"], 3), round(fit["intercept"], 3), fit["months"]) == (5881.294, 125183.440, 48)


def test_seasonality(monthly):
    rows = in_order(M.month_seasonality(monthly), "calendar_month", "seasonality_index")
    assert [(m, round(v, 4)) for m, v in rows] == list(enumerate(SEASONALITY, start=1))


def test_smoothing_growth_and_average(monthly):
    fits = in_order(M.exp_smoothing(monthly, "sales"), "month", "sales_exp_smooth_fit")
    assert {i: round(fits[i][1], 4) for i in SMOOTH} == SMOOTH
    growth = in_order(M.mom_growth(monthly, ["sales", "profit"]), "sales_mom_growth", "profit_mom_growth")
    assert growth[0] == (None, None)
    assert {i: tuple(round(v, 4) for v in growth[i]) for i in GROWTH} == GROWTH
    average = in_order(M.moving_avg(monthly, ["sales", "profit"]), "sales_3m_moving_avg", "profit_3m_moving_avg")
    assert average[1] == (None, None)
    for i, expected in AVERAGE.items():
        assert average[i] == pytest.approx(expected, abs=2e-4)  # the monthly figures are rounded themselves


def test_series_do_not_mix(spark, monthly):
    both = monthly.withColumn("k", F.lit("a")).unionByName(
        monthly.select("month", (F.col("sales") * 2).alias("sales"), "profit", "orders").withColumn("k", F.lit("b"))
    )
    found = M.sales_forecast(both, ["k"]).orderBy("k", "forecast_month").collect()
    assert [round(r["forecast_sales"], 2) for r in found[:6]] == FORECAST
    assert [r["forecast_sales"] / 2 for r in found[6:]] == pytest.approx([r["forecast_sales"] for r in found[:6]])


def test_empty_months_stay(spark):
    rows = [("A", dt.date(2020, 1, 5), 5.0, 1.0, 1, 0.1), ("B", dt.date(2020, 3, 9), 7.0, 2.0, 2, 0.3), ("C", None, 9.0, 1.0, 1, 0.0)]
    lines = spark.createDataFrame(rows, "order_id string, order_date date, sales double, profit double, quantity int, discount double")
    months = in_order(M.monthly_rollup(lines, "order_date"), "month", "sales", "orders", "avg_discount", "profit_margin")
    assert months == [
        (dt.date(2020, 1, 1), 5.0, 1, 0.1, 0.2),
        (dt.date(2020, 2, 1), 0.0, 0, None, 0.0),
        (dt.date(2020, 3, 1), 7.0, 1, 0.3, 2.0 / 7.0),
    ]
    growth = in_order(M.mom_growth(M.monthly_rollup(lines, "order_date"), ["sales"]), "sales_mom_growth")
    assert growth == [(None,), (-1.0,), (None,)]  # from zero there is no growth rate


def test_unseen_month_has_no_forecast(spark):
    rows = [(dt.date(2020, m, 1), float(m), 1.0, 1) for m in range(1, 5)]
    monthly = spark.createDataFrame(rows, "month date, sales double, profit double, orders long")
    assert [r["forecast_sales"] for r in M.sales_forecast(monthly).collect()] == [None] * 6
