"""Analytics over 3D-capture tables as Spark DataFrame operations."""
