"""Models read stored bars, not all orders again and again."""

from tidemark.plans import table_queries


def test_models_do_not_read_orders(spark):
    for name in ("ar5_forecast", "ar1_forecast", "trend_season_forecast"):
        files = getattr(table_queries, name)(spark, "/root/testdata/sf0.001").inputFiles()
        assert files and not any("orders.parquet" in f for f in files)
