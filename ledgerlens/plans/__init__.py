"""The analytics: views, quality, KPI queries, features, measures, statistics."""
