"""Table operators that the plans are put together from."""
