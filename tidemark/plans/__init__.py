"""The analytical products, each a function from DataFrames to a DataFrame.

``entity`` is the list of key columns that separate independent logs (athlete,
user, customer ...). An empty list treats all rows as one log.
"""
