"""Training-data operators over document tables. Nothing outside imports this package."""
