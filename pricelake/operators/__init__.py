"""Layer transformations: cleaned layer, calendar, SCD2, fact, marts, audits."""
