"""Named analyses over the housing and energy tables."""
