"""Hand-shaped plans: order, intervals and similarity without hot tasks."""
