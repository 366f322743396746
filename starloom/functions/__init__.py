"""Column-expression helpers (text, dates)."""

from starloom.functions import dates, text

__all__ = ["dates", "text"]
