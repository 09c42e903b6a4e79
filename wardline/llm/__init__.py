"""Training-data operators: dedup, mixing, extraction, archives, chat, scoring, joins, tokenisation."""
