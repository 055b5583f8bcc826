"""Relational jobs: cost, chargeback, allocation, views, forecast, reconciliation."""
