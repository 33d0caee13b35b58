"""Operators over readings: roll-ups, counter differences, late routing, leak."""
