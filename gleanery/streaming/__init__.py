"""Available-now streaming intake."""
