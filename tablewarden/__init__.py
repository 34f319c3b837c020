"""Data-quality, integrity, split and release-audit operators for Spark tables.

Every operator takes a ``DataFrame`` and returns a ``DataFrame``.  Operators
that need a number before they can build their plan (a fill value, a split
cut-off, a bin edge) fetch that number with a small, size-bounded action and
put it into the plan as a literal.
"""
