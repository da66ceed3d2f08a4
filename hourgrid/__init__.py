"""Trip-record analytics and zone-hour demand forecasting as Spark DataFrame jobs."""
