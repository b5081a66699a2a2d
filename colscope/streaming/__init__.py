"""File events as streams."""
