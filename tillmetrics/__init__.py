"""Retail transaction analytics expressed as Spark DataFrame jobs.

Sub-packages:

* ``functions``  - column expressions (dates, amounts, ids, fingerprints)
* ``sources``    - CSV datasets, the columnar landing copy, result sinks
* ``operators``  - aggregation, ranking, lookup and reconciliation on DataFrames
* ``plans``      - the four questions, composed from the operators
* ``streaming``  - the same questions as checkpointed Structured Streaming jobs
"""

from tillmetrics.params import Params

__all__ = ["Params"]
