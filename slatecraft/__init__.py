"""Contest analytics as Spark jobs: normalised tables, marts and reports."""
