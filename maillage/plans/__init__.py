"""Named views, reports and access rules built from the operators."""
