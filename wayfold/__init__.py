"""Ride matching and mobility analytics expressed as Spark DataFrame jobs."""
