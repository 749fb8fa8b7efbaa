"""Candles, technical indicators and market reads as Spark jobs."""
