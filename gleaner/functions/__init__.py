"""Column expressions: text, dates, URLs, feed fields and documents."""
