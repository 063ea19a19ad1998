"""Independent SQL for every registered query, to compare results with another engine."""
