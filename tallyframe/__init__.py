"""Relational reporting and safe table changes as Spark DataFrame plans."""
