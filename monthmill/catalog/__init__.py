"""The registered queries: inputs derived from the test tables, Spark queries, reference SQL."""
