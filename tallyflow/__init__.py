"""Traffic metrics (PV / UV / IP / active users) as Spark DataFrame jobs."""
