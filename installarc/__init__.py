"""Install-lifetime cohort and revenue analytics as PySpark DataFrame plans."""
