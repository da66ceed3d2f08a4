"""DataFrame-to-DataFrame operators; none of them runs a job by itself
unless its docstring says so."""
