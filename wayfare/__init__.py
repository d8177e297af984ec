"""Customer-journey analytics as Spark jobs.

Bronze deliveries -> consented staging -> identity graph -> sessions,
touchpoints and attribution -> star schema -> reports, checks and erasure.
Every step is a function from DataFrames to a DataFrame.
"""
