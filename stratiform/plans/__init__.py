"""The layers: bronze load, silver, gold, backfill, quality, exploration, warehouse."""
