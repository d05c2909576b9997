"""The registered queries: the operators applied to the given tables, each with an independent SQL check."""
