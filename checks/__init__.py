"""The registered queries: inputs made from the given tables, Spark jobs, reference SQL."""
