"""corpusloom: raw web crawls to clean, deduplicated, token-level corpora on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function made of native
Spark expressions, so the same code serves batch jobs and Structured Streaming.
"""

__version__ = "0.1.0"
