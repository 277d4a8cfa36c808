"""martloom: build and query a retail star schema with plain Spark."""
