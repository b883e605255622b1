"""Writes: target table (Parquet or JDBC), load metrics, high-water marks."""
