"""Analytics over frame-indexed episodes as Spark jobs."""
