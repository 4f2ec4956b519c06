"""Column-expression helpers and board-aware Arrow functions."""
