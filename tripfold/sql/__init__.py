"""Spark SQL counterparts of the DataFrame operators, for users who query in text."""
