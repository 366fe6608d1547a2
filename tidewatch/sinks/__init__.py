"""Table writers."""
