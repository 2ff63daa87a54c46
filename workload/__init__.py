"""Log lines rendered from the given tables, and the SQL to check against."""
