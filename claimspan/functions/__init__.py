"""Column helpers and the measure layer."""
