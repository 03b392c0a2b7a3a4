"""Building blocks that plain DataFrame calls do not offer in one step."""
