"""Column -> Column helpers: JSON codecs, exact averages, calendar expressions."""
