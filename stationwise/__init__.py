"""stationwise: property x transit proximity analytics as Spark DataFrame jobs.

Bronze -> silver -> gold: clean a property assessment roll, select rail
stations from a stops table, attach each neighbourhood's nearest station
(exact, grid equi-joins, no cross join), bucket the distance, aggregate
per neighbourhood, and serve the gold tables as DataFrame queries.
Every function takes and returns DataFrames; none creates a session.
"""

__version__ = "0.1.0"
