"""Readers, writers and the hand-over of small results."""
