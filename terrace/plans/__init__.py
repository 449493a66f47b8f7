"""Named queries by subject, each with the SQL that it is held against."""
