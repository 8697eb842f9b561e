"""Where data comes from and goes to: message streams and tables."""
