"""Column functions: identifiers, addresses, 256-bit integers, scores and metrics."""
