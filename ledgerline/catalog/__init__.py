"""Every operator and report on the test tables, each with its SQL counterpart."""
