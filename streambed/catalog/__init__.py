"""The registered queries: domain views over the shared tables, the queries, and their oracles."""
