"""Column helpers: local time, behaviour measures, ratios and labels."""
