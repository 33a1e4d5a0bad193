"""Named queries and the SQL each one is compared with."""
