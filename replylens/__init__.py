"""replylens: first-response analytics for customer chats on Spark.

Packages:
  functions  Column builders (dates, times, scores, names, chat metadata)
  sources    CSV scans and test-table adapters
  sinks      CSV/snapshot writers
  operators  DataFrame -> DataFrame operators (inbox, chats, leads, schedule, ...)
  plans      named queries and their SQL oracles
  streaming  Structured Streaming forms of the incremental operators
"""

__version__ = "0.1.0"
