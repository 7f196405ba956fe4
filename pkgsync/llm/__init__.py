"""Operators for building training data from documents.

One module per operator, each with a general function over a DataFrame of documents; ``queries.py`` holds the
thin registered queries and ``oracles.py`` the DuckDB SQL of those that SQL can express.  Nothing outside this
package (but ``__spark_entry__.py``, which guards for its absence, and ``corpus_pipeline.py``) imports it.
"""
