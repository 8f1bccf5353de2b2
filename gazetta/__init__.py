"""gazetta: a Spark-native gazetteer builder.

Turns raw tab-separated geographic dumps (language codes, alternate names,
administrative areas, countries, cities, regions) into curated gazetteer
tables. Every step is a plain ``DataFrame -> DataFrame`` function built on
Spark's own expressions, joins, aggregates and windows.
"""

__version__ = "0.1.0"
