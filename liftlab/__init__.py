"""liftlab: product-experiment and next-best-offer analytics on PySpark."""

from liftlab.settings import Settings

__all__ = ["Settings"]
