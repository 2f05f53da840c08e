"""Readers and writers: raw deliveries, published cubes and the star-schema views."""
