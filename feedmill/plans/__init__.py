"""The composites a user calls: feed, loan, marketing, marts, report."""
