"""Column functions: text, dates, hashing, nested documents."""
