"""Jobs, stand-ins for the generated tables and the query registry."""
