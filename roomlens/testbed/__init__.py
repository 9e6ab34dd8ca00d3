"""The engine on the driver's test tables: input adapter, query registry, SQL oracles."""
