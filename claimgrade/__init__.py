"""Grading of self-reported capability claims, as Spark DataFrame operators."""
