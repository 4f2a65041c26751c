"""Braidline: multi-rate sensor streams on one clock, as Spark DataFrame work."""
