"""The registered queries: dirty feeds derived from the given tables, and what runs on them."""
