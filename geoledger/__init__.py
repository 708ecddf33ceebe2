"""Territorial housing and review analytics as lazy Spark plans."""
