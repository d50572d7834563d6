"""DataFrame operators for documents, web pages and transcripts on Spark."""

__version__ = "0.1.0"
