"""Named queries over the given tables, each with SQL that states its result."""

from postmill.catalogue import details, loads, streams, tables

ENTRIES = {**tables.ENTRIES, **loads.ENTRIES, **details.ENTRIES, **streams.ENTRIES}
