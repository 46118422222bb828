"""Reusable frame operators: joins on hot keys, ranking, de-duplication, change sets."""
