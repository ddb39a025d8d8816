"""Operators over tables: ranking, pairing, epoch plans, losses and confusion scores."""
