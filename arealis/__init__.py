"""Small-area panel analytics as Spark DataFrame operators.

Layout
------
``functions``  Column -> Column builders (calendar, window features, geography)
``operators``  DataFrame -> DataFrame operators
``sources``    schemas, readers and sinks
``plans``      end-to-end jobs built from the operators
"""
