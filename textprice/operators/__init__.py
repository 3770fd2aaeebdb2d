"""Relational, statistical, feature, model and time-series operators (DataFrame -> DataFrame)."""
