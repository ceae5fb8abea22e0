"""Where pixels, boundaries, lines and tables come from."""
