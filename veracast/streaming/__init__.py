"""Stream scoring, sinks and rolling activity."""
