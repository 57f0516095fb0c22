"""Sequence and table analytics as composable Spark DataFrame operators."""
