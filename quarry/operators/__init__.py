"""DataFrame -> DataFrame operators (clean, keys, merge, facts, analytics,
quality).  Each composes built-in Spark expressions; none uses a Python UDF."""
