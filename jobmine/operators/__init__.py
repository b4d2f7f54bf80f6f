"""DataFrame operators; column names are parameters throughout."""
