"""glossweave: a Spark-first engine for multilingual terminology data.

Everything is a plain function from DataFrames to DataFrames; see README.md for
the map of packages.  The optional subpackage ``glossweave.llm`` holds operators for
training text and is imported by nothing else in the library.
"""

__version__ = "0.1.0"
