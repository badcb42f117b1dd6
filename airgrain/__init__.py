"""Daily air-quality analytics and forecasting over many series, as Spark DataFrame operators."""
