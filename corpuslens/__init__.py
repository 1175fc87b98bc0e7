"""Bibliographic and text-corpus analytics as PySpark DataFrame operators."""
