"""riskloom: Spark-native analytics for vulnerability feeds, tables and streams.

Every operator is a plain ``DataFrame -> DataFrame`` function whose column names
are parameters, so it runs on any table.
"""
