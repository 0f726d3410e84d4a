"""Series without SQL cover all lines."""

from pyspark.sql import functions as F

from sluice.plans import adapter as a
from sluice.plans import series_queries
from tests.test_oracle import SF


def test_forecast_covers_all_lines(spark):
    total = lambda df: float(df.agg(F.sum(F.col("quantity").cast("decimal(18,4)"))).first()[0])
    assert total(series_queries.ml8_gbt_forecast(spark, SF)) == total(a.lines(spark, SF).where("doc_date >= '2001-01-01'"))
