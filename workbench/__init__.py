"""The given tables seen as trips and zones, with a query and an oracle per operator."""
