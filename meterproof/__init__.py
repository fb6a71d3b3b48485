"""meterproof: billing assurance for metered sessions, written as Spark DataFrame jobs."""
