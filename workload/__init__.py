"""The operators of bulkflow as named queries over the test tables, each beside its SQL."""
