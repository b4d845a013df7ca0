"""Operators on readings: de-duplicate, filter, resample, align, reshape."""
