"""Event-log and precinct-result analytics as Spark DataFrame operators."""
