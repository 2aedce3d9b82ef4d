"""The library's jobs on the driver's tables, and the SQL they must agree with."""
