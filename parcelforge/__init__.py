"""Parcelforge: DataFrame operators for property-style data on Spark."""
