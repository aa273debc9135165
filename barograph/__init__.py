"""barograph: sensor-telemetry analytics as Spark jobs.

Every transform takes and returns a DataFrame and works the same on batch and
on streaming input.
"""

__version__ = "0.1.0"
