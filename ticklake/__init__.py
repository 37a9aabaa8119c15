"""ticklake: exchange trades and dividend events as Spark DataFrame jobs.

Layout:
  schemas      StructTypes, decimal types and the fixed values the results depend on
  session      SparkSession defaults and the shared checkpoint folder
  functions/   Column -> Column expressions (money, time, text)
  sources/     scans: driver tables, derived trade/dividend inputs, archives, JSON events
  operators/   pure DataFrame -> DataFrame operators (parse, views, cursor, dividends, ...)
  sinks/       keyed-replace writers for gold tables and event logs
  streaming/   Structured Streaming queries built from the same operators
  plans/       the named query catalogue run by the driver and the bench
"""

__version__ = "0.1.0"
