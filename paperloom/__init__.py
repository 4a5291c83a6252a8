"""paperloom: document collections to retrieval chunks, vectors and diverse subsets on Spark.

Every operator is a function from DataFrame to DataFrame. Nothing here builds a
session, and no operator brings data rows to the driver other than the checked,
bounded side tables named in its docstring.
"""

__version__ = "0.1.0"
