"""Jobs (compositions of operators), the query registry and the SQL oracle."""
