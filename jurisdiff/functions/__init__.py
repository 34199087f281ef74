"""Column functions: text, URL, date and code normalisation."""
