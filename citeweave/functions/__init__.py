"""Column functions: text, URLs, JSON payloads, HTML."""
