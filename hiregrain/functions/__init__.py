"""Column functions: text cleaning, URLs, linked data and page signals."""
