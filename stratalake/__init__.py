"""Layered commerce tables on Spark: landing, bronze, silver, gold, quality and audit."""
