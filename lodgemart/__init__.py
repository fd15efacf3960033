"""Batch analytics over hospitality bookings, written as Spark DataFrame jobs."""
