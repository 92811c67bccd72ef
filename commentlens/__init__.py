"""commentlens: Spark jobs for studying large collections of public comments."""
