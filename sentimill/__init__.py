"""Review analytics as Spark DataFrame jobs: profile, clean, balance, model, score, report."""
