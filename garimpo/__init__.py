"""Procurement lakehouse operators as Spark DataFrame transformations."""
