"""Column -> Column helpers.  Everything here is a built-in Spark expression:
no Python UDF, so it stays inside whole-stage codegen."""

from pricetide.functions.exprs import *  # noqa: F401,F403
