"""Analytics over keyed, append-only logs, written for Spark."""
