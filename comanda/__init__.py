"""Order-and-reservation analytics on PySpark: star schema, sales, graph, routes."""
