"""Reading the landing folder and the stored layers."""
