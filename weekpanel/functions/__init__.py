"""Column expressions (JVM-side built-ins only)."""

from weekpanel.functions.calendar import epi_week, epi_week_start, epi_year, week_cos, week_sin, circular_distance
from weekpanel.functions.scalar import age_in_years, growth, lenient_int, lenient_double, hash_uniform, clamp
from weekpanel.functions.text import normalize_text, normalize_header

__all__ = [
    "epi_week", "epi_week_start", "epi_year", "week_cos", "week_sin", "circular_distance",
    "age_in_years", "growth", "lenient_int", "lenient_double", "hash_uniform", "clamp",
    "normalize_text", "normalize_header",
]
