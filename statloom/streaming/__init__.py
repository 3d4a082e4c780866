"""Empty on purpose: the analyses covered here are all batch jobs.

Low-latency scoring is a batch transform over a filtered query, see
``statloom.learn.scoring``.
"""
