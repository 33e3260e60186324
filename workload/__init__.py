"""The operators applied to the test tables, with equivalent SQL."""
