"""pradera: livestock and pasture analytics as Spark DataFrame code.

Sub-packages
------------
sources    readers for landed extracts, files and API dumps; writers (sinks)
functions  Column -> Column helpers (codes, dates, text, recodes, categories)
operators  DataFrame -> DataFrame operators (calendar grid, ordered scans,
           reset counters, reconciliation, keys, aggregates, reshaping)
plans      the jobs users run, composed from operators, and the query catalog
           over the shared test tables
"""

__version__ = "0.1.0"
