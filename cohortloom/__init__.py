"""Audience and entity analytics as composable Spark DataFrame operators."""
