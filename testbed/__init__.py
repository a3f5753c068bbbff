"""Facts and cards made from the test tables, the registered queries, and their oracles."""
