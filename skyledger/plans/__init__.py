"""Jobs put together from the operators: ingest, backfill, replay, rollup refresh and table upkeep."""
