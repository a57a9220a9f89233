"""Complete jobs: loads, the star they produce, and the questions asked of it."""
