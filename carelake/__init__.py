"""carelake: layered (Bronze / Silver / Gold) record pipelines as plain Spark DataFrame functions."""
