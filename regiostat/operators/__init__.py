"""Relational building blocks: latest positions, windows, ranks, pivots, alignment, quality."""
