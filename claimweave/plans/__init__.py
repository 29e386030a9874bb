"""Jobs, and the queries that run the operators over the test tables."""
