"""Silver, dimension, gold, analytic and refresh jobs."""
