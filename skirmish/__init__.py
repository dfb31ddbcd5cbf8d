"""skirmish: match analytics on Spark.

Turns raw match data into normalised match events, ban counts, sliding-window
statistics, a player-versus-player property graph and reporting marts, all as
DataFrame / SQL / Structured Streaming plans that Catalyst optimises and Spark
distributes.
"""

__version__ = "0.1.0"
