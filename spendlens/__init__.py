"""Entity spend and activity analytics as PySpark DataFrame operators."""
