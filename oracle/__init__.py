"""SQL counterparts of the registered queries, for an independent engine."""
