"""kestrel: analytical queries over tables, graphs and log streams, built on
Spark's DataFrame and Structured Streaming operators.

Every query is a function from DataFrames to a DataFrame. Actions (writes,
counts pulled to the driver) happen only at the edges: sinks, the iterative
graph loops' convergence checks, and tests.
"""

__version__ = "0.1.0"
