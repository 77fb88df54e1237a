"""paywatch: payment-monitoring features, checks, sampling, scoring and evaluation as Spark jobs."""
