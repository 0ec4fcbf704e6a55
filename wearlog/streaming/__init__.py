"""Live sensor events."""
