"""dealflow: filing-event analytics as Spark DataFrame jobs.

Layout
------
functions/  column-expression builders (Column -> Column), no actions
operators/  DataFrame -> DataFrame transforms (joins, aggregates, windows)
sources/    readers for landed files and tables, and sinks
plans/      derived fixture views, registered queries and their SQL oracles
streaming/  Structured Streaming forms of intake, de-duplication and bars
"""

__version__ = "0.1.0"
