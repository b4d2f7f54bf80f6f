"""The row-local scoring steps on a stream of new postings."""
