"""Spark-first data plane for image-translation datasets: listing, pairing, epochs, pixels, losses and evaluation."""
