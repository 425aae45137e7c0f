"""demandgrid: retail demand analytics as Spark DataFrame, SQL and ML jobs."""
