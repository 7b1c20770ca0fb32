"""Column functions and text readers."""
