"""Run configuration, extension registry and end-to-end plans."""
