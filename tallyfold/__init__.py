"""Demographic headcount ETL and geography rollups as composable PySpark DataFrame operators."""
