"""Marlstone sources."""
