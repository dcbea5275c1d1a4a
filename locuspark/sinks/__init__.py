"""Writers for the stored database and for text outputs."""
