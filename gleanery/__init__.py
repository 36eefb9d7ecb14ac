"""Document curation analytics as composable Spark DataFrame operators."""
