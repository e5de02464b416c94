"""Part of pagewright."""
