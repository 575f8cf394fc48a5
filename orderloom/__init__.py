"""orderloom: order analytics for disagreeing source systems, as Spark DataFrames.

Raw tables -> staging -> validated orders -> marts -> trends and reports.
Every operator is a function from DataFrames to a DataFrame; nothing runs until
the caller acts on the result, except where a docstring says so.
"""
