"""torqline: predictive-maintenance analytics expressed as Spark jobs."""
