"""Connected components: see ``operators.components``."""

from ..operators.components import components

__all__ = ["components"]
