"""Scheduled loads as streaming jobs that stop when the input is used up."""
