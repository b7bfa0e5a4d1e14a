"""Product, revenue and support analytics as plain DataFrame functions."""
