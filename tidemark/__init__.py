"""tidemark: sales cleaning, event aggregates, audits, archiving, message
hand-over and page extraction as PySpark DataFrame and streaming jobs."""
