"""Match-outcome analytics on PySpark: profiling, preparation, selection, models, metrics."""
