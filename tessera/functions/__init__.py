"""Column functions: identifiers, dates, text and rule tables."""
