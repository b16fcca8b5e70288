"""Named query plans over the supplied tables and their SQL twins."""
