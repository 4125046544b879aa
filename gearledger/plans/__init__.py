"""Jobs, and the named queries with their checking SQL."""
