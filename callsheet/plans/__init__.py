"""Query plans: the three campaign lists, the weekly batch, and the catalogue."""
