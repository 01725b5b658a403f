"""Layered (bronze, silver, gold) analytics as Spark DataFrame operators."""
