"""The operators bound to the driver's tables, and the same questions in SQL."""
