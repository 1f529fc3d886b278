"""starloom — a retail star-schema warehouse and its analyses, written for Spark.

Layers:

* ``starloom.sources``   — table schemas, the test-data adapter, warehouse storage.
* ``starloom.functions`` — column expressions (dates, text, money, labels, scores).
* ``starloom.operators`` — DataFrame operators: dimensions, fact, RFM, ranking,
  loads (append / insert-if-absent / upsert), quality checks, derived shapes.
* ``starloom.plans``     — the pipeline and the named analyses (SQL reports and
  dashboard queries).
* ``starloom.streaming`` — incremental (Structured Streaming) fact loading.
"""

__version__ = "0.1.0"
