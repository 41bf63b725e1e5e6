"""rackpulse: server-telemetry analytics as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame built from Column
expressions, joins, aggregates and windows, so Catalyst plans it and it runs
over many servers and days in one job.
"""

__version__ = "0.1.0"
