"""DataFrame operators: cleaning, roll-ups, ranking, text picks, basket pairs."""
