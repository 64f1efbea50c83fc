"""Column builders: text, addresses, times, money."""
