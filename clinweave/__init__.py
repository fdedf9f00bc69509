"""Clinweave: curation, splitting and retrieval of question-answer corpora as Spark jobs."""

__version__ = "0.1.0"
