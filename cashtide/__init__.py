"""Intraday cash positions on Spark: payment quality, balances, alerts, flows, pending queue."""
