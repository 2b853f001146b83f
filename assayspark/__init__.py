"""assayspark: omics and molecule-string data steps as Spark DataFrame operators."""

__version__ = "0.1.0"
