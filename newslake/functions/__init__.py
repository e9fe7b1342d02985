"""Column expressions: text, time, HTML and vectors."""
