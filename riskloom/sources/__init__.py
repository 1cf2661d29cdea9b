"""Table readers, writers and the frames derived from the driver tables."""
