"""The analyses and their building-block operators, as DataFrame functions."""
