"""Composed plans: preprocessing/model pipelines, daily features, the query catalog."""
