"""Column -> Column expressions shared by every operator (all JVM-side built-ins)."""

from ticklake.functions import money, text, timefmt  # noqa: F401
