"""Complete plans: the customer and order product, its daily run, and the query catalogue."""
