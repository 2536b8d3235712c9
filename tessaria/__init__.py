"""Tessaria: dataset curation and training-data preparation as Spark jobs."""
