"""Daily weather interpolation as Spark jobs."""
