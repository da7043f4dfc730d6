"""Column expressions (dates, exact decimals, seeded draws) — all JVM-side built-ins."""
