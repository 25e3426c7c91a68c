"""Product-usage metrics for B2B accounts on PySpark."""

from .config import DOCUMENTED, LITERAL, Config

__all__ = ["DOCUMENTED", "LITERAL", "Config"]
