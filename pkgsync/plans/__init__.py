"""Composed jobs: migration plan, actions, waves, resume, post-check."""
