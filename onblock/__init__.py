"""Delay analytics for scheduled trips, written as plain PySpark DataFrame operators."""
