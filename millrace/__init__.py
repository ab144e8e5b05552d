"""Text, conversation and preference tables turned into token rows on Spark."""
