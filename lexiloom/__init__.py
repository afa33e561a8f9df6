"""lexiloom: a document-corpus analytics engine written for PySpark.

Everything takes and returns DataFrames.  ``sources`` read and write, ``functions`` are column
expressions, ``operators`` are DataFrame-to-DataFrame building blocks, ``kernel`` is the small pure
Python recogniser that the Arrow UDFs call, ``plans`` binds them to queries, ``streaming`` holds the
Structured Streaming extension.  The optional subpackage ``llm`` holds the training-data operators;
nothing outside it imports it.
"""

__version__ = "0.1.0"
