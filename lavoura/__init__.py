"""Lavoura: rural-credit lakehouse analytics expressed as Spark DataFrame jobs."""
