"""Marketplace sales, price and bonus analytics as lazy Spark DataFrame operators."""
