"""The analyses: silver order table, customer scores, reports, documents, dashboard tables and churn features."""
