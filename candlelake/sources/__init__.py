"""Scans: landed responses, the target table, literal rows, and adapters over the driver's tables."""
