"""The row-wise steps on unbounded JSON lines."""
