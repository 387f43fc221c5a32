"""Analytics operators for ratings, review text, orders and JSON-line streams on PySpark."""
