"""Cohort telemetry monitoring as Spark DataFrame code."""
