"""The analytical queries and the jobs around them."""
