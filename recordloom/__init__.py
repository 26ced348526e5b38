"""Unique, checked text records from documents, queries and model responses, as Spark jobs."""
