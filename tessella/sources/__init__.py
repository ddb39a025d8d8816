"""Listing and decoding of image folders, and sinks for images, reports and logs."""
