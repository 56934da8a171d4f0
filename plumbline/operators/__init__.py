"""DataFrame-to-DataFrame operators, one module per check family."""
