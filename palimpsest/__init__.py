"""Versioned-document analytics as Spark DataFrame plans."""
