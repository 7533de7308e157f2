"""DataFrame operators of the loading path."""
