"""Replay of histories and loading of message streams."""
