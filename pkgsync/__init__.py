"""pkgsync: reconcile package repositories with Spark DataFrames.

Sub-packages
------------
functions  Column expressions on paths, coordinates and names (no I/O).
sources    Readers: catalogue / listing / target dumps, artifact bytes, test fixtures.
operators  DataFrame -> DataFrame building blocks: inventory, state, ledger, documents.
plans      Composed jobs: migration plan, actions, waves, resume, post-check.
streaming  Nothing: the migration has no unbounded input (see its docstring).
"""

__all__ = ["functions", "sources", "operators", "plans"]
