"""Where data comes from and goes to: topics, lake documents and tables."""
