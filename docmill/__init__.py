"""Bulk document-to-Markdown conversion as Spark jobs."""

from docmill.options import ConvertOptions

__all__ = ["ConvertOptions"]
