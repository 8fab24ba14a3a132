"""Query plans over the driver tables: derivations, registered queries,
their SQL oracles, and the bronze -> silver -> gold stage order."""
