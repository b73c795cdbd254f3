"""Turn a stored corpus of web pages and JSON documents into clean, keyed tables with Spark."""
