"""Column expressions: money, calendar, ratings, text and row predicates."""
