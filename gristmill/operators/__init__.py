"""DataFrame to DataFrame operators over document tables."""
