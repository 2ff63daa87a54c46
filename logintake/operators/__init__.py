"""DataFrame operators: parse, route, chunk, number and report."""
