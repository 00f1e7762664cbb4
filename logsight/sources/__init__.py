"""Where query events come from and where results are kept."""
