"""Layer plans: silver, gold, insights, segmentation, pipeline."""
