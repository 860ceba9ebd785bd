"""Registered queries: each operator bound to the test tables, with the SQL it must agree with."""
