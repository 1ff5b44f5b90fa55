"""Running the stateless operators on streams."""
