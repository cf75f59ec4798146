"""Readers, landing writers and table publishing."""
