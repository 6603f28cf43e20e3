"""The stateless steps over arriving files."""
