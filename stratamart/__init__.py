"""Layered retail analytics on Spark: landing, cleaning, history, star schema."""
