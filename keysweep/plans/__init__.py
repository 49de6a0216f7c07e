"""Composite jobs: purge one table, purge from a manifest, restore a backup."""
