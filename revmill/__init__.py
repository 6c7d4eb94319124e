"""Review analytics on Spark: cleaning, counting, labelling, training and evaluation as DataFrame jobs."""

from revmill.config import ReviewConfig

__all__ = ["ReviewConfig"]
