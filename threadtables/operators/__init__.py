"""DataFrame-to-DataFrame operators on notes, reviews, papers and profiles."""
