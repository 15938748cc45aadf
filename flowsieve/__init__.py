"""Flow analytics and intrusion scoring as PySpark DataFrame operators."""
