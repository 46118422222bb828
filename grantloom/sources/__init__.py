"""Readers and writers: workbooks, summary reports, staging files, stored tables."""
