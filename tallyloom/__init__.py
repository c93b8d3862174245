"""Tallyloom: the data side of language-model post-training as Spark jobs."""

__version__ = "0.1.0"
