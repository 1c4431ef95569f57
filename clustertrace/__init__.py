"""Analytics over compute-cluster traces, written with the Spark DataFrame API.

``sources``    typed readers, row checks, result writers, the trace views of the test tables
``functions``  column expressions
``operators``  reusable DataFrame operators; column names are parameters
``plans``      the thirteen ready analytics, composed of the operators

Everything is lazy: a function takes DataFrames and returns a DataFrame. No
function starts a session, collects rows or runs a Python UDF.
"""
