"""roadpulse: toll-gantry traffic analytics as PySpark DataFrame jobs."""
