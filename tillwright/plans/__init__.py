"""The layers: silver, quality, gold, views, and the job that runs them."""
