"""The service-request plans: raw rows to clean rows to a star, roll-ups and reports."""
