"""lectio: reading-history analytics as lazy Spark DataFrame operators.

Bronze (landed feeds, pages, lookup responses) -> silver (latest batch,
typed, parsed) -> gold (daily page allocation, genre summary) -> serving
views (rolling means, date ranges, dense user x genre matrices).
Every operator takes and returns DataFrames and never collects.
"""

__version__ = "0.1.0"
