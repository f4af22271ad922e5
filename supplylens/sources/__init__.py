"""Table readers, the domain model built on them, and table writers."""
