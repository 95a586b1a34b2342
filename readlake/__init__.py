"""readlake: sequencing-read and corpus analytics as lazy PySpark DataFrame operators."""
