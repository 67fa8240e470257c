"""Named queries over the input tables and the SQL they are checked against."""
