"""DataFrame -> DataFrame operators (cleaning, changes, load, analytics, derived, extraction)."""
