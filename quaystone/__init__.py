"""quaystone: data-contract and data-quality engine on the PySpark DataFrame API."""

__version__ = "0.1.0"
