"""The analyses: churn risk, cohort retention, rolling revenue."""
