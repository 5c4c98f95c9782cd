"""All queries of the library: importing the plans registers them."""

from tallyforge.plans import audits, cleaning, fixpoints, further, groups, identities, orderings, readers, relations, reports, selection, texts  # noqa: F401
from tallyforge.registry import ORACLES, QUERIES  # noqa: F401
