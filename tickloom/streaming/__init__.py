"""Running the transforms as streaming queries."""
