"""Part of the aid-statistics engine."""
