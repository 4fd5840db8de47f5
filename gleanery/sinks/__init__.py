"""Sinks: JSON, text, CSV, HTML, and the explicit application of rename plans."""
