"""Operators for preparing text corpora on Spark; nothing outside this folder imports them."""
