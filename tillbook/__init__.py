"""tillbook: small-business order and expense ledgers as Spark jobs.

Every public function maps ``DataFrame -> DataFrame`` or ``Column -> Column``.
Nothing runs until a sink, a check or a caller's action asks for it.
"""

__version__ = "0.1.0"
