"""Book-review analytics as Spark DataFrame jobs: clean, stage, upsert, rank, gate."""
