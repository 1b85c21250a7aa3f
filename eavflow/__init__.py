"""eavflow: attribute-value records to wide analytical views, on Spark.

Everything is DataFrame / SQL code: scans, pivots, lookup joins, link walks,
work selection and incremental conversion all run as Spark jobs whose number
does not grow with the number of records or files.
"""

__version__ = "0.1.0"
