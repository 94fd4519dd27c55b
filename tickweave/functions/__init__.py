"""Column helpers: segmented series windows and scalar cleaning functions."""
