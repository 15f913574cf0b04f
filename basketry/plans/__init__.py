"""Named query plans (Q01-Q23, K01-K49, B1-B9) and their oracle SQL."""
