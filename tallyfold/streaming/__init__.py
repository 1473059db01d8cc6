"""The same folds on Structured Streaming.

Updates carry no event time and count when they arrive, so the state queries use
no watermark and their state grows with the number of keys, not of rows. Reports
do have a time and drop late polls.
"""
