"""Spark-native web-corpus indexing and BM25 search.

Sub-packages:

* ``functions`` – column-expression builders (tokenizer, HTML text, URLs,
  BM25 maths).  Everything there is a pure ``Column -> Column`` function, so
  it stays inside whole-stage code generation.
* ``sources``   – readers/writers for the Bronze, Silver and Gold tables and
  the index export.
* ``operators`` – DataFrame -> DataFrame operators (index build, search,
  robots rules, crawl frontier, politeness, fetch-log analytics, reports).
* ``plans``     – the registered queries over the driver tables and their
  DuckDB twins.
* ``streaming`` – Structured Streaming versions of the incremental stages.
"""

__version__ = "0.1.0"
