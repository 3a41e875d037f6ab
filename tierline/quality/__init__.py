"""Quality checks: violations-only DataFrames with anti-vacuity floors."""
