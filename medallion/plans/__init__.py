"""Business plans: entity cleaning, issue bookkeeping, star schema, views, scoring, retrieval."""
