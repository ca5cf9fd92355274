"""All registered queries."""

from brooklet.catalog import blocks, changes, jobs, joins, records, rules, sinks, visits, windows  # noqa: F401
from brooklet.catalog import patterns, streams  # noqa: F401
from brooklet.catalog.registry import ORACLES, QUERIES  # noqa: F401
