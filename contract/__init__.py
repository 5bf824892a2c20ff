"""What the driver runs: the queries, the projection they start from, and the SQL to check them."""
