"""Reading, writing and message encoding."""
