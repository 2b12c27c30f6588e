"""revloom: revenue-operations analytics as reusable, scale-out PySpark DataFrame operators.

Layers, lowest first:

* ``functions``  column expressions (casts, safe division, month/day arithmetic, score)
* ``operators``  DataFrame operators (flatten, keep-first, lookup join, upsert, batches, checks)
* ``sources``    landing files in, versioned and clustered tables out
* ``plans``      the models: staging, cleaning, marts, metrics, reports, checks, export
* ``streaming``  incremental and streaming upsert
"""

__version__ = "0.1.0"
