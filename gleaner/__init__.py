"""Curation of software projects and text corpora as Spark DataFrame jobs."""
