"""Promolake: retail-offer analytics as Spark DataFrame operators."""
